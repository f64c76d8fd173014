import os
import random

import pytest

pytest.importorskip("tidemark.llm")
tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import tokenizer as T

PATH = f"{T.FOLDER}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=T.load_ranks(PATH), special_tokens={})


TEXTS = [
    "", " ", "Hello world", "Договор № 12345/6 от 01.02.2024", "don't we'll I'M 'sup", "\x1c\x1d a\x00b", "a\r\n\r\n  b\t\tc ", "日本語のお客様 ขอบคุณ 👍🏽😊", "<|endoftext|> <s></s>", "½²Ⅷ٣ x　y z",
    "lock0b0e" * 300, "!" * 999, "ОООО" * 200, "   " * 100 + "x", "naïve façade é́́", "퟿", "aaaa" * 500,
]


def ids(text):
    return np.frombuffer(T.encode_text(text, PATH), np.int32).tolist()


def test_against_the_reference_implementation(reference):
    rng = random.Random(3)
    alphabet = list("abcdeABC 12,.!'\n\té日яЖ№%") + ["the", " of", "'ll", "😊", "​", "  "]
    for t in TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(1, 80))) for _ in range(400)]:
        assert ids(t) == reference.encode_ordinary(t), repr(t[:60])


def test_round_trip(reference):
    for t in TEXTS:
        assert b"".join({v: k for k, v in T.load_ranks(PATH).items()}[i] for i in ids(t)).decode() == t


def test_prefix_table_holds_the_last_token_of_every_prefix():
    enc = T.PrefixEncoder(T.load_ranks(PATH))
    data = "unbelievably".encode()
    last = enc.extend(data, __import__("array").array("i"), 0)
    for n in range(1, len(data) + 1):
        assert enc.encode(data[:n])[-1] == last[n - 1]
    grown = enc.extend(data + b"good", last, len(data))
    assert enc.walk(grown) == enc.encode(data + b"good")


def test_append_and_edit(reference):
    rng = random.Random(5)
    for _ in range(150):
        text = "".join(rng.choices(["ab", " c", "'", "'s", "12", " ", "\n", "ж", "!"], k=rng.randrange(0, 25)))
        e = T.EncodedText(text, PATH)
        for _ in range(4):
            a = rng.randrange(len(e.text) + 1)
            b = rng.randrange(a, len(e.text) + 1)
            more = "".join(rng.choices(["x", " ", "'l", "l", "9", "\n"], k=rng.randrange(4)))
            e.append(more) if rng.random() < 0.4 else e.replace(a, b, more)
            assert e.ids == reference.encode_ordinary(e.text), repr(e.text)


def test_appends_go_on_where_the_encoding_stopped(reference):
    e = T.EncodedText("see un", PATH)
    for more in ("believ", "ab", "ly", "good", "  ", "x", "!", "", "日", "本"):
        e.append(more)
        assert e.ids == reference.encode_ordinary(e.text), repr(e.text)
    assert e.extended > 0
    long = T.EncodedText("", PATH)
    for i in range(200):
        long.append("lock0b0e")
    assert long.ids == reference.encode_ordinary("lock0b0e" * 200)


def test_corpus_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, "  "), (4, "text"), (4, "text"), (None, "word")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit(2))
    got = sorted((r["doc_id"] or 0, list(r["ids"])) for r in T.encode_corpus(df).collect())
    assert got == [(0, ids("word")), (1, []), (2, []), (3, ids("  ")), (4, ids("text")), (4, ids("text"))]
    assert T.encode_corpus(df.limit(0)).count() == 0
    assert sorted(r["n_tokens"] for r in T.count_tokens(df).collect()) == sorted([0, 0, len(ids("  ")), 1, 1, 1])


def test_memory_of_pieces_is_bounded(monkeypatch, reference):
    monkeypatch.setattr(T, "MEMO_PIECES", 3)
    memo = T._Memo(T.PrefixEncoder(T.load_ranks(PATH)))
    for w in ["a", " b", " c", " d", " e", " a"]:
        assert list(np.frombuffer(memo[w], np.int32)) == reference.encode_ordinary(w)
        assert len(memo) <= 3
