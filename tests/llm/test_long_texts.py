"""Very long texts take time in proportion to their length; paraphrases are retrieved."""

from __future__ import annotations

import random
import re
import time

import cases
import pytest

from duesmith.llm import decontamination, guessing, personal_data, secret_scan

KINDS = personal_data.KINDS


def _timed(limit, work):
    start = time.perf_counter()
    found = work()
    assert time.perf_counter() - start < limit
    return found


@pytest.mark.parametrize("value", ["a" * 5_000_000, "qw" * 2_500_000, "abcd" * 1_250_000, "x7#kQ9!z" * 600_000 + "?"])
def test_costs_of_long_values(value):
    _timed(5, lambda: guessing.guess_cost(value, enough=secret_scan.LEAST_COST))


@pytest.mark.parametrize(
    ("text", "kind", "n"),
    [
        ("password is " + "a" * 5_000_000, "guess", 0),
        ("token" + " " * 5_000_000, "guess", 0),
        ("token= " * 500_000, "assign", 0),
        ("password=abcdefgh1 " * 250_000, "assign", 250_000),
        ("secret " * 700_000, "guess", 0),
        ("0123456789abcdef" * 300_000, "hex", 1),
    ],
)
def test_secrets_of_long_texts(text, kind, n):
    found = _timed(10, lambda: secret_scan.find_secrets(text))
    assert sum(k == kind for k, _, _ in found) == n


def _plain_cost(value, words):
    """Every split, by plain recursion over places."""
    from math import inf, log10

    best = [0.0] + [inf] * len(value)
    low = value.translate(guessing._LOWER)
    plain = low.translate(guessing.LOOKALIKES)
    for i in range(len(value)):
        parts = [(i + 1, guessing._at_random(value[i]))]
        for j in range(i + 3, len(value) + 1):
            for form, extra in ((low, 0), (plain, log10(4))):
                if form[i:j] in words.rank:
                    mixed = 0 if value[i:j] in (low[i:j], low[i:j].upper()) else log10(4)
                    parts.append((j, log10(words.rank[form[i:j]] + 1) + mixed + extra + log10(2)))
            date = guessing._date(value[i:j]) if 4 <= j - i <= 10 else None
            if date is not None:
                parts.append((j, date + log10(2)))
        for size in (1, 2, 3, 4):
            unit, copies = value[i : i + size], 1
            while len(unit) == size and value[i + size * copies : i + size * (copies + 1)] == unit:
                copies += 1
            if size * copies > max(2, size):
                parts.append((i + size * copies, sum(map(guessing._at_random, unit)) + log10(copies) + log10(2)))
                break
        j = i + 1
        while j < len(value) and low[j - 1 : j + 1] in guessing._NEAR:
            j += 1
        if j - i >= 4:
            parts.append((j, log10(len(guessing._PLACE) * (j - i) * 4) + log10(2)))
        for j, cost in parts:
            best[j] = min(best[j], best[i] + cost)
    return best[-1]


def test_costs_match_a_plain_segmentation():
    rng = random.Random(6)
    words = guessing.Words(["protected", "agreement", "standard", "haus"])
    parts = ["password", "P4ssword", "qwer", "asdfgh", "1999", "20010203", "aaa", "abab", "x", "7", "!", "Haus", "AGREEMENT", "zz", "12312", "é"]
    for _ in range(1500):
        value = "".join(rng.choices(parts, k=rng.randint(1, 6)))
        cost = guessing.guess_cost(value, words)
        assert cost == pytest.approx(_plain_cost(value, words))
        assert (guessing.guess_cost(value, words, 10.0) >= 10.0) == (cost >= 10.0)


def test_ordinary_words_are_no_secrets(spark):
    texts = ["a password protected page", "the secret agreement of the token standard", "password protected, secret agreement, token standard"]
    rows = [(i, texts[i % 3]) for i in range(30)] + [(100, "the password is x7#kQ9!zWv and that is secret zebrafinch")]
    found = secret_scan.secret_spans(cases.documents(spark, rows))
    spans = {(row["doc_id"], s["value"]) for row in found.collect() for s in row["found"] if s["kind"] == "guess"}
    assert spans == {(100, "x7#kQ9!zWv"), (100, "zebrafinch")}  # a word of one document alone is none


def test_common_words_are_chosen_by_frequency(spark):
    rows = [(i, " ".join([f"often{c}" for c in "abc"] + [f"w{chr(97 + i % 26)}{chr(97 + k)}x" for k in range(20)])) for i in range(260)]
    rows += [(1000 + i, "rare words stand here") for i in range(3)] + [(2000, None), (2001, "")]
    every = secret_scan.common_words(cases.documents(spark, rows))
    assert len(every) == 3 + 26 * 20 and set(every[:3]) == {"oftena", "oftenb", "oftenc"}
    some = secret_scan.common_words(cases.documents(spark, rows), most=100)
    assert every[:3] == some[:3] and 60 < len(some) < 140 and set(some) < set(every)
    assert secret_scan.common_words(cases.nothing(spark)) == []


LONG = {
    "letters": "x" * 400_000 + " @ y",
    "letters and a domain": "x" * 400_000 + "@a.b",
    "numbers": " ".join(str(i) for i in range(20_000)),
    "addresses": "1.2.3.4 " * 20_000,
    "digits": "7" * 400_000 + ".",
    "marks": "@" + "!" * 400_000 + "1",
    "mails": "a@b.cd " * 20_000,
    "pluses": "+1 " * 50_000,
}
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
}


def test_personal_data_of_long_texts(spark):
    rows = [(i, text) for i, text in enumerate(LONG.values())]
    docs = cases.documents(spark, rows)
    personal_data.personal_spans(cases.documents(spark, [(1, "a@b.cd 1.2.3.4 12")])).collect()
    found = _timed(90, lambda: personal_data.personal_spans(docs).collect())
    counts = {list(LONG)[row["doc_id"]]: tuple(len(row[kind]) for kind in KINDS) for row in found}
    assert counts == {
        "letters": (0, 0, 0, 0), "letters and a domain": (1, 0, 0, 0), "numbers": counts["numbers"], "addresses": (0, 20_000, 0, 0),
        "digits": (0, 0, 0, 0), "marks": (0, 0, 0, 0), "mails": (20_000, 0, 0, 0), "pluses": (0, 0, 0, 0),
    }
    by_id = {row["doc_id"]: row for row in found}
    places = [(s["start"], s["end"]) for s in by_id[list(LONG).index("mails")]["email"]]
    assert places == [(7 * i, 7 * i + 6) for i in range(20_000)]


def test_mails_and_addresses_that_touch_match_the_plain_patterns(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "b.c", "@", "_", "-", ".", "1", "23", "256", "1.2", " ", "%", "é"], k=rng.randint(1, 40))) for _ in range(600)]
    got = personal_data.personal_spans(cases.documents(spark, list(enumerate(texts)))).collect()
    for row in got:
        for kind, pattern in PLAIN.items():
            plain = [m.span() for m in re.finditer(pattern, texts[row["doc_id"]], re.ASCII)]
            if kind == "ip":
                plain = [(a, b) for a, b in plain if all(int(p) <= 255 for p in texts[row["doc_id"]][a:b].split("."))]
            assert [(s["start"], s["end"]) for s in row[kind]] == plain, texts[row["doc_id"]]


def test_paraphrases_are_retrieved(spark):
    """Items whose words are changed here and there, planted into documents of the corpus."""
    rng = random.Random(9)
    sf = "/root/testdata/sf0.01"
    texts = [row["text"] for row in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect() if row["text"]]
    items = [(row["item_id"], row["text"]) for row in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    vocabulary = [word for text in texts[:100] for word in text.split()]
    rows, planted = [], set()
    for n in range(240):
        item_id, text = items[n % len(items)]
        words = text.split()
        for at in rng.sample(range(len(words)), len(words) // 5):
            words[at] = rng.choice(vocabulary)
        host = rng.choice(texts).split()[:400]
        at = rng.randint(0, len(host))
        rows.append((n, " ".join([*host[:at], *words, *host[at:]])))
        planted.add((n, item_id))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(row["doc_id"], row["item_id"]) for row in decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(found & planted) >= 0.9 * len(planted)
