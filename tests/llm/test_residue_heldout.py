"""Residue on texts that are not of the test corpus: public error pages, mail templates, documentation and prose.

The first two lists were written before the grammars were run on them and are
measured; REVIEWED holds cases that were pointed out and must come out right.
"""

import pytest

pytest.importorskip("tidemark.llm")

from tidemark.llm.residue import residue_kind

PROSE = " The committee met in the small hall and went through the accounts of the past year without haste, item by item, until everyone had spoken."
RU = " Комиссия собралась в малом зале и без спешки разобрала счета за прошлый год, пункт за пунктом, пока не высказались все."

POSITIVE = [
    "Dear {{customer_name}}, your order has shipped." + PROSE,
    "Hi {firstName}, thanks for joining us!" + PROSE,
    "Hello %FIRSTNAME%, we have news for you." + PROSE,
    "Welcome back, *|FNAME|*!" + PROSE,
    "Dear [Customer Name],\n\nThank you for your purchase." + PROSE,
    "Sincerely,\n[Your Name]\n[Your Title]" + PROSE,
    "This agreement is made on <<EffectiveDate>> between the parties." + PROSE,
    "The invoice total is ${invoice.total} and is due at once." + PROSE,
    "Ship to: <%= @order.address %>" + PROSE,
    "Posted on {% post_date %} by the editors." + PROSE,
    "Hello {0}, you are customer number {1}." + PROSE,
    "Total: $NaN, payable within a month." + PROSE,
    "Your meeting is on Invalid Date at the main office." + PROSE,
    "Customer: [object Object]\nPhone: undefined" + PROSE,
    "Name: null null\nCity: NULL;\nReference 17." + PROSE,
    "Dear undefined, your booking is confirmed." + PROSE,
    "Contact us at <INSERT PHONE NUMBER> for details." + PROSE,
    "Company: <company_name>, Address: <street_address>" + PROSE,
    "The price is #REF! for each of the units." + PROSE,
    "Уважаемый {{имя_клиента}}, ваш заказ готов." + RU,
    "Уважаемая [ИМЯ], напоминаем о визите." + RU,
    "Договор № {номер_договора} от {дата} заключён в городе." + RU,
    "Сумма к оплате: #ЗНАЧ! рублей." + RU,
    "Дата рождения: ДД.ММ.ГГГГ, место рождения указано ниже." + RU,
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit.",
    "About us. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat." + PROSE,
    "Placeholder text goes here." + PROSE,
    "Click to add text",
    "Здесь будет текст раздела." + RU,
    "asdf asdfgh qwerty qwerty",
    "404 Not Found\nnginx/1.18.0",
    "403 Forbidden",
    "Error 500 (Server Error)!!1\nThat's an error.\nThere was an error. Please try again later.\nThat's all we know.",
    "502 Bad Gateway\nThe proxy server received an invalid response from an upstream server.",
    "Service Unavailable\nThe server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later.",
    "Not Found\n\nThe requested URL was not found on this server.\n\nApache/2.4.6 (CentOS) Server at www.example.com Port 80",
    "Access Denied\nYou don't have permission to access this resource on this server.\nReference #18.2d351ab8.1557333295",
    "HTTP Error 503. The service is unavailable.",
    "This page isn't working right now. If the problem continues, contact the site owner. HTTP ERROR 500",
    "This site can’t be reached\nThe connection was reset.\nERR_CONNECTION_RESET",
    "You need to enable JavaScript to run this app.",
    "JavaScript is not available. We've detected that JavaScript is disabled in this browser. Please enable JavaScript or switch to a supported browser to continue.",
    "Please enable cookies. Checking your browser before accessing the site. Ray ID: 6b1c2d3e4f5a",
    "Just a moment... Verify you are human by completing the action below.",
    "Your session has expired. Please log in again.",
    "Fatal error: Uncaught Error: Call to undefined function get_header() in /var/www/index.php on line 12",
    "Traceback (most recent call last):\n  File \"app.py\", line 3, in <module>\nKeyError: 'total'",
    "{\"error\": {\"code\": 403, \"message\": \"" + "detail " * 300 + "\"}}",
    "Internal Server Error\nThe server encountered an internal error and was unable to complete your request.",
    "Страница не найдена. Возможно, она удалена или перемещена. Вернуться на главную",
    "Ошибка 403. Доступ запрещён.",
    "Для корректной работы сайта включите JavaScript в настройках браузера.",
    "Сервис временно недоступен. Попробуйте позже.",
    "Ваш сеанс истёк, войдите снова.",
]

NEGATIVE = [
    "In Jinja a variable is written as `{{ user.name }}` and printed in the template when it is rendered." + PROSE,
    "To greet the reader, put the placeholder \"{{first_name}}\" at the top of the template." + PROSE,
    "Install it like this:\n\n```\nexport TOKEN=${API_TOKEN}\n```\n" + PROSE,
    "The function takes a dict:\n\n    def greet(user):\n        return \"Hello {{name}}\".format(user)\n\nand returns text." + PROSE,
    "He paid $500 in cash and kept the receipt." + PROSE,
    "The interval [a, b] is closed and {x : x > 0} is a set." + PROSE,
    "See [1] and [Smith 2004] for the proof [emphasis added]." + PROSE,
    "None of the guests complained." + PROSE,
    "None came, and none were sent for." + PROSE,
    "Terms left undefined here have their usual meaning." + PROSE,
    "Division by zero is undefined." + PROSE,
    "The query returns NULL for such rows." + PROSE,
    "Please write your name here: ______________ and the date: ____________." + PROSE,
    "The Null hypothesis was rejected at the five percent level." + PROSE,
    "The museum's web page was not found worthy of a prize, said the jury in its long report on the year." + PROSE,
    "Last week our site answered 503 Service Unavailable for an hour, because a disk was full. We moved the logs away and nobody complained afterwards.",
    "We explain how to enable JavaScript in five browsers, why pages ask for it, and what happens to menus and forms without it. Older readers of this column will remember that plain pages served us well for years.",
    "Cookies: mix butter, sugar and flour, bake for twelve minutes and let them cool before serving with cold milk to the hungry children.",
    "Access to the roof is closed until Friday while the painters finish the north side of the chimney and the gutters." ,
    "The file on the case was moved to the archive in March, and nobody has asked for it since the hearing ended without a verdict.",
    "Сервер в подвале заменили, ошибка больше не повторялась, бухгалтерия довольна и работает в обычном режиме." + RU,
    "Страница 404 книги посвящена осаде крепости и тем, кто её пережил." + RU,
    "Договор не найден в архиве, копию запросили у подрядчика в понедельник, ответ ждём к пятнице вместе с актами сверки.",
    "Подпись: ________________ Дата: ____________" + RU,
    "Печенье (cookies) подаём к чаю после обеда, рецепт у повара." + RU,
    "Email me at john@example.com or use #hashtag for questions." + PROSE,
    "Temperatures fell to -5°C <again> in the valley." + PROSE,
    "vector<int> and map<string, double> are containers." + PROSE,
    "The discount is 5%, that is 10% less than last year's 15%." + PROSE,
    "Use ~approximately~ in chat to strike a word through." + PROSE,
    "[Laughter] Thank you. [Applause] Let us begin with the first slide." + PROSE,
    "The Latin phrase \"in vino veritas\" is older than the tavern that bears it." + PROSE,
    "Call the method obj.toString() and you may see [1, 2, 3]." + PROSE,
    "Set the PATH with export PATH=$PATH:/usr/local/bin and log in again." + PROSE,
    "He shouted: \"What???\" and left." + PROSE,
    "Rated XXX by the censors, the film never reached our town." + PROSE,
    "Meeting minutes. Any other business: none. Next meeting in May." + PROSE,
    "The test test of the device went well; we repeated the test twice." + PROSE,
    "The form asks for the date as day, month and year." + PROSE,
    "",
    "   ",
    "ok",
    "Хорошо, жду в 15:00",
]

REVIEWED = [
    (None, "Every class may define `__init__`, and modules compare __name__ with __main__." + PROSE),
    (None, "A module knows its __name__, a class its __dict__." + PROSE),
    (None, "A column that holds NULL never equals another one." + PROSE),
    (None, "Pandas marks missing values as NaN." + PROSE),
    (None, "[Music] Good evening. [Applause]" + PROSE),
    (None, "Open %APPDATA% and delete the folder." + PROSE),
    (None, "A List<String> holds texts." + PROSE),
    (None, "$TSLA and $AAPL rose, [NATO] said, as [McDonald] of the [U.S.] desk told us." + PROSE),
    (None, "We did it together #teamwork# and went home." + PROSE),
    (None, "None taller than him stood there." + PROSE),
    (None, "The variable may become undefined after the second call." + PROSE),
    (None, "Write the mail like this:\n\n    Dear {{first_name}},\n    print(greeting);\n\nThat is all." + PROSE),
    ("placeholder", "Hello {0}, you have {1} messages." + PROSE),
    ("placeholder", "Hello {{ user.profile['name'] }}, welcome." + PROSE),
    ("placeholder", "Total: <%= order.total() %> EUR." + PROSE),
    ("placeholder", "Dear $NAME, welcome." + PROSE),
    ("placeholder", "Hello :first_name, welcome." + PROSE),
    ("error_page", "Server Error\n404 - File or directory not found.\nThe resource you are looking for might have been removed, had its name changed, or is temporarily unavailable."),
    ("error_page", "Forbidden\nYou don't have permission to access this resource.\nApache/2.4.41 (Ubuntu) Server at example.com Port 80"),
    ("error_page", "Please turn JavaScript on and reload the page."),
    ("error_page", "SQLSTATE[HY000] [2002] Connection refused"),
    ("filler", "Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam." + PROSE),
]


def test_recall_and_precision_on_texts_of_other_origin():
    missed = [t for t in POSITIVE if residue_kind(t) is None]
    wrong = [t for t in NEGATIVE if residue_kind(t) is not None]
    found = len(POSITIVE) - len(missed)
    assert found / len(POSITIVE) >= 0.9, missed
    assert found / (found + len(wrong)) >= 0.9, wrong


@pytest.mark.parametrize("kind,text", REVIEWED)
def test_reviewed_cases(kind, text):
    assert residue_kind(text) == kind
