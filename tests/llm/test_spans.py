"""Secret scans and personal data."""

from __future__ import annotations

import hashlib
import random
import re

import cases
import pytest

from duesmith.llm import personal_data, secret_scan
from duesmith.llm.guessing import guess_cost

_CASELESS = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token")
)
ASSIGN = re.compile(
    rf"""({_CASELESS}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def _base_secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)]


def _fuzzed(parts, n, seed):
    rng = random.Random(seed)
    return [(i, "".join(rng.choices(parts, k=rng.randint(0, 14)))) for i in range(n)]


def test_secret_base_spans_against_plain_patterns(spark, monkeypatch):
    parts = ["Password", "secret", "TOKEN", "api_key", "ApiKey", "ſecret", " ", ":", "=", '"', "'", "abcdefgh", "0123456789abcdef",
             "AKIA", "ABCDEFGHIJKL", "é", "\n", "x", "."]
    rows = [*cases.ROWS, *_fuzzed(parts, 3000, 3)]
    docs = cases.documents(spark, rows)
    monkeypatch.setattr(secret_scan, "read_table", lambda *_: docs)
    got = secret_scan.op8_secrets(spark, "").collect()
    expected = sorted(
        (repr(i), hashlib.sha256(",".join(_base_secrets(text or "")).encode()).hexdigest()) for i, text in rows
    )
    assert sorted((repr(row["doc_id"]), row["base_sha256"]) for row in got) == expected
    assert all(row["spans"].count("hex:") == row["n_hex"] for row in got)
    assert secret_scan.secret_spans(cases.nothing(spark)).count() == 0


def test_guess_costs_rank_passwords():
    easy = ["password1", "qwertyuiop", "aaaaaaaaaa", "20240131", "P@ssw0rd2024", "abababababab"]
    hard = ["xK9#mQ2$vL", "f3ef4d6b2755", "V7-pLq.92zRt"]
    assert max(map(guess_cost, easy)) < secret_scan.LEAST_COST <= min(map(guess_cost, hard))
    assert guess_cost("") == 0
    assert guess_cost("z" * 5000) < 10 < guess_cost("zq8" + "x7!" * 100)


def test_values_in_context_are_added_unless_easy():
    text = "the password is xK9#mQ2$vL! and pwd qwertyuiop but token: abcdefgh12"
    assert secret_scan.find_secrets(text) == [("guess", 16, 26), ("assign", 51, 68)]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _base_personal(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if _valid(kind, m[0])
    ]


@pytest.fixture(scope="module")
def personal(spark):
    parts = ["a", "1", "22", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", ".", "@", "+", " ", "-",
             "(", ")", "x@y.z", "1.2.3.4", "300.1.1.1", "0001.2.3.255", "é", "😀", "\n", "a@b.co_x@d.com",
             "+1 202 555 0100", "1.2.3.4.5.6.7.8"]
    rows = [*cases.ROWS, *[(10_000 + i, text) for i, text in _fuzzed(parts, 600, 2)]]
    rows += [(20_001, "1 " * 3000), (20_002, "a." * 3000 + "@b" + ".c" * 3000), (20_003, "9" * 20_000)]
    rows += [(30_000 + i, f"please call me at +1 202 555 01{i:02d} or later") for i in range(8)]
    rows += [(40_000 + i, f"please call me at 202-555-9{i:03d}, thanks") for i in range(2)]
    rows += [(50_000, "room 202-555-9999 is closed")]
    docs = cases.documents(spark, rows)
    original = personal_data.read_table
    personal_data.read_table = lambda *_: docs
    try:
        got = personal_data.op9_personal_data(spark, "").collect()
    finally:
        personal_data.read_table = original
    return rows, got


def test_personal_base_spans_against_plain_patterns(personal):
    rows, got = personal
    expected = sorted(
        (repr(i), hashlib.sha256(",".join(_base_personal(text or "")).encode()).hexdigest()) for i, text in rows
    )
    assert sorted((repr(row["doc_id"]), row["base_sha256"]) for row in got) == expected


def test_contexts_discover_identifiers(personal):
    spans = {row["doc_id"]: row["spans"] for row in personal[1]}
    assert spans[40_000] == spans[40_001] == "like_phone:18:30"
    assert spans[50_000] == ""


def test_personal_data_of_nothing_uses_no_python(spark):
    found = personal_data.personal_spans(cases.nothing(spark))
    assert found.count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_found_numbers_lead_to_further_contexts(spark):
    rows = [(i, f"please call me at +49 30 {5550000 + i} today") for i in range(60)]
    rows += [(100 + i, f"please call me at 030{7770000 + i} today") for i in range(12)]
    # No fixed form stands in this context, only numbers that the other one has found.
    rows += [(200 + i, f"better ring on 030{7770000 + i} instead") for i in range(12)]
    rows.append((300, "better ring on 0308880000 instead"))
    rows.append((301, "nobody counts 0309990000 here"))
    found = {r["doc_id"]: r["added"] for r in personal_data.personal_spans(cases.documents(spark, rows)).collect()}
    assert [(s["kind"], s["value"]) for s in found[300]] == [("like_phone", "0308880000")]
    assert found[301] == []
