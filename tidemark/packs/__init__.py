"""A small neutral rule pack, and a loader for packs kept as JSON or YAML."""

from __future__ import annotations

import json
from pathlib import Path

from ..operators.rules import Rule

#: Weights are whole tenths once multiplied by a source's factor.
DEFAULT = [
    Rule("path_finance", "path", {"department": "finance"}, 10, tokens=("бухгалтерия", "invoices", "счета", "accounts")),
    Rule("path_legal", "path", {"department": "legal", "sensitivity": "legal"}, 10, tokens=("contracts", "договоры и акты", "договоры", "legal")),
    Rule("path_engineering", "path", {"department": "engineering"}, 8, tokens=("эксплуатация", "инженерия", "чертежи", "проектная документация")),
    Rule("path_hr", "path", {"department": "hr", "sensitivity": "personal"}, 9, tokens=("персонал", "hr", "training")),
    Rule("path_housekeeping", "path", {"department": "housekeeping"}, 7, tokens=("housekeeping", "прачечная")),
    Rule("path_archive", "path", {"lifecycle": "archive"}, 6, patterns=(r"архив", r"\bold\b")),
    Rule("name_contract", "filename", {"document_type": "contract", "department": "legal"}, 9, tokens=("договор", "contract"), negative_tokens=("без договора",)),
    Rule("name_act", "filename", {"document_type": "act"}, 8, tokens=("акт", "act of acceptance")),
    Rule("name_invoice", "filename", {"document_type": "invoice", "department": "finance"}, 9, tokens=("invoice", "счет"), patterns=(r"сч[её]т\s+\d+",)),
    Rule("name_estimate", "filename", {"document_type": "estimate", "department": "engineering"}, 8, tokens=("смета",)),
    Rule("name_plan", "filename", {"document_type": "plan"}, 7, tokens=("план эвакуации", "floor plan", "чертеж")),
    Rule("name_report", "filename", {"document_type": "report"}, 6, tokens=("report", "отчет"), negative_patterns=(r"draft|черновик",)),
    Rule("name_timesheet", "filename", {"document_type": "timesheet", "department": "hr"}, 8, tokens=("табель", "timesheet")),
    Rule("name_sop", "filename", {"document_type": "sop"}, 7, tokens=("sop", "регламент")),
    Rule("name_minutes", "filename", {"document_type": "minutes"}, 6, tokens=("meeting notes", "протокол")),
    Rule("name_draft", "filename", {"lifecycle": "draft"}, 5, tokens=("черновик", "draft")),
    Rule("name_final", "filename", {"lifecycle": "final"}, 5, tokens=("final", "signed", "финал")),
    Rule("ext_sheet", "extension", {"family": "table"}, 6, extensions=("xlsx", "csv"), mime_prefixes=("application/vnd.google-apps.spreadsheet",)),
    Rule("ext_text", "extension", {"family": "text"}, 6, extensions=("docx", "txt", "pdf")),
    Rule("ext_media", "extension", {"family": "media"}, 6, mime_prefixes=("image/", "video/")),
    Rule("ext_archive", "extension", {"family": "archive", "lifecycle": "archive"}, 4, extensions=("zip",)),
    Rule("sens_guest", "sensitivity", {"sensitivity": "guest"}, 6, tokens=("guest", "гость", "гости", "check-in")),
    Rule("sens_personal", "sensitivity", {"sensitivity": "personal"}, 6, tokens=("персонал", "passport", "паспорт")),
    Rule("sens_money", "sensitivity", {"sensitivity": "financial"}, 5, tokens=("invoice", "statement", "смета", "сверки")),
    Rule("media_photo", "media", {"media": "photo"}, 5, tokens=("photo", "фото"), extensions=("jpg", "png")),
    Rule("clean_system", "cleanup", {"cleanup": "system"}, 9, tokens=("thumbs.db", ".ds_store", "desktop.ini")),
    Rule("clean_unnamed", "cleanup", {"cleanup": "unnamed"}, 0, tokens=("без имени", "новый документ", "untitled")),
]


#: Keys that a rule kept in a file may have.
KEYS = frozenset("rule_id source category targets target_fields weight tokens keywords patterns regex_patterns negative_tokens negative_patterns negative_regex_patterns extensions mime_prefixes explanation".split())


def _read(path: str) -> list[dict]:
    text = Path(path).read_text("utf-8-sig")
    if path.endswith((".yml", ".yaml")):
        import yaml

        data = yaml.safe_load(text)
    else:
        data = json.loads(text)
    return list((data["rules"] if isinstance(data, dict) else data) or ())


def unknown_keys(path: str) -> list[tuple[str, str, str]]:
    """(level, rule_id, message) of keys that no rule has, which are mostly misspelt."""
    return [("warning", str(r.get("rule_id") or ""), f"unknown key {k}") for r in _read(path) for k in sorted(map(str, r)) if k not in KEYS]


def load(path: str) -> list[Rule]:
    """Rules from a list of mappings; `keywords` is another name of tokens, `regex_patterns` and `target_fields` of patterns and targets."""
    listed = lambda r, *names: tuple(str(x) for n in names for x in (r.get(n) or ()))
    return [
        Rule(
            str(r.get("rule_id") or ""), str(r.get("source") or r.get("category") or "filename"), {k: str(v) for k, v in (r.get("targets") or r.get("target_fields") or {}).items()}, r.get("weight", 10),
            listed(r, "tokens", "keywords"), listed(r, "patterns", "regex_patterns"), listed(r, "negative_tokens"), listed(r, "negative_patterns", "negative_regex_patterns"), listed(r, "extensions"), listed(r, "mime_prefixes"),
        )
        for r in _read(path)
    ]
