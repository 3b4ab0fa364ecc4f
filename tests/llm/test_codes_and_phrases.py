"""Phrases, quality scores and vector codes."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import cases
import duckdb
import numpy as np
import pyarrow as pa
import pytest

from duesmith.llm import phrases, quality, vector_codes

PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
CODE = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


# --- phrases ---


def _plain_phrases(rows, most_words=4, least=30, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    longer = defaultdict(int)
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                longer[part] = max(longer[part], a)
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * longer[lang, words] >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, best in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


def _texts(spark, rows):
    names = "".join(f", {name} string" for name in ("segment", "next", "prefix", "f", "n", "phrase", "k"))
    filled = [(i, text, lang, *["x"] * 7) for i, (text, lang) in enumerate(rows)]
    return spark.createDataFrame(filled, f"doc_id long, text string, lang string{names}")


def test_phrases_match_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = cases.rows_of(phrases.op11_phrases(spark, sf), *PHRASE)
    assert got and got == cases.tuples(cases.duck(phrases.OP11_CHECK, sf), *PHRASE)


def _hot_rows():
    rng = random.Random(5)
    vocabulary = ["the", "of", "The", "naïve", "ß", "x-1", "a" * 300, "日本", "\x00"]
    rows = []
    for _ in range(300):
        words = rng.choices(vocabulary, [9, 5, 3, 2, 1, 1, 1, 1, 1], k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", ","]) for w in words)
        rows.append((text, rng.choice(["en", "en", None, "und", ""])))
    return [*rows, ("the of " * 20_000, "en")]


def test_phrases_of_long_texts_and_hot_prefixes(spark):
    rows = _hot_rows()
    got = cases.rows_of(phrases.collocations(_texts(spark, rows).repartition(7)), *PHRASE)
    assert got == _plain_phrases(rows)
    few = cases.rows_of(phrases.collocations(_texts(spark, rows), most_words=3, least=5, top=7), *PHRASE)
    assert few == _plain_phrases(rows, 3, 5, 7)


def test_stripes_of_many_portions_add_up(monkeypatch):
    for name, value in (("ROW_ELEMENTS", 2), ("BATCH_ROWS", 3), ("PORTION", 500), ("HELD_ELEMENTS", 20)):
        monkeypatch.setattr(phrases, name, value)
    rows = _hot_rows()
    rows = [(text, "und" if lang is None else lang) for text, lang in rows]
    batch = pa.RecordBatch.from_pydict({"lang": [lang for _, lang in rows], "text": [text for text, _ in rows]})
    parts = list(phrases._added(iter([batch.slice(0, 100), batch.slice(100)]), 1, None))
    assert len(parts) > 5
    found = Counter()
    for elements, langs, words in parts:
        for stripe in phrases._rows(elements, 1, langs, words, 4, None):
            for row in stripe.to_pylist():
                following, counts = row["next"].split(" "), map(int, row["n"].split(" "))
                assert row["prefix"] == "" and len(following) <= 2
                found.update({(row["lang"], word): n for word, n in zip(following, counts)})
    plain = Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.split(r"[\x20\x09.,;:!?\x0A-\x0D]+", lowered)
        plain.update((lang, word) for word in words if word)
    assert found == plain


def test_stripes_of_hot_prefixes_are_cut(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HOT_COUNT", 40)
    rows = _hot_rows()
    got = cases.rows_of(phrases.collocations(_texts(spark, rows)), *PHRASE)
    assert got == _plain_phrases(rows)


def test_phrase_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    huge = 1 << 50

    def levels(docs, most_words, least):
        first = [("en", "", "", 4 * huge), ("en", "", "a", huge + 3), ("en", "", "b", huge + 1)]
        return [
            spark.createDataFrame(first, "lang string, prefix string, next string, f long"),
            spark.createDataFrame([("en", "a", "b", huge)], "lang string, prefix string, next string, f long"),
        ]

    monkeypatch.setattr(phrases, "stripe_levels", levels)
    (row,) = phrases.collocations(None, most_words=2).collect()
    assert row["score"] == 2000000 * huge // (2 * huge + 4) and row["n"] == 4 * huge


def test_phrases_of_odd_rows(spark):
    assert phrases.collocations(_texts(spark, [])).count() == 0
    assert phrases.collocations(_texts(spark, [(None, None), ("", "en"), (" ..\n", "de")])).count() == 0
    tied = [("b a x. a b x", None)] * 30
    got = cases.rows_of(phrases.collocations(_texts(spark, tied)), *PHRASE)
    assert got == _plain_phrases(tied)


# --- quality ---


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op12_quality(spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    both = got[got["held_out"]].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.98


def test_quality_never_reads_held_out_labels(spark):
    labels = spark.read.parquet(f"{cases.SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet")
    other = labels.withColumn("quality", quality.F.expr("if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality)"))
    one, two = (cases.rows_of(quality.quality(docs, rows), "doc_id", "score") for rows in (labels, other))
    assert one == two


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (6, None), (7, 1), (7, 0)], "doc_id long, quality int")
    scored = quality.quality(cases.documents(spark), labels)
    assert scored.count() == len(cases.ROWS)
    assert scored.where("score is null or score not between 0 and 1").count() == 0
    assert quality.quality(cases.nothing(spark), labels).count() == 0
    unlabelled = quality.quality(cases.documents(spark), labels.limit(0))
    assert {row["score"] for row in unlabelled.collect()} == {0.5}
    kept = quality.score_rows(cases.documents(spark), quality.learn(cases.documents(spark), labels), "its_score")
    assert kept.columns == [*cases.documents(spark).columns, "its_score"]


def test_statistics_do_not_depend_on_neighbours():
    texts = [text for _, text in cases.ROWS] + ["A line.\nA line.\n\nB", "x" * 300_000, "!!! ### 12 12 12"]
    together = quality.statistics(pa.array(texts))
    alone = np.concatenate([quality.statistics(pa.array([text], pa.string())) for text in texts])
    assert np.isfinite(together).all()
    np.testing.assert_allclose(together, alone, rtol=1e-5)
    by_name = dict(zip(quality.NAMES, together[len(cases.ROWS)]))
    assert by_name["distinct_lines"] == pytest.approx(2 / 3)
    assert by_name["kind_%d" % quality.LINE] == pytest.approx(3 / 18)
    assert not together[2].any() and not together[3].any()


def _walk(trees, row):
    margin = trees.base
    for feature, edge, leaf in zip(trees.feature, trees.edge, trees.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > edge[node] else 1)
        margin += leaf[node - len(feature)]
    return 1 / (1 + math.exp(-margin))


def test_flat_trees_match_a_walk_and_learn_an_interaction():
    rng = np.random.default_rng(3)
    stats = rng.normal(size=(2000, 5)).astype(np.float32)
    labels = ((stats[:, 1] > 0) ^ (stats[:, 3] > 0.5)).astype(float)
    trees = quality.grow(stats[:1500], labels[:1500])
    scores = trees.score(stats)
    assert ((scores[1500:] >= 0.5) == labels[1500:]).mean() > 0.95
    np.testing.assert_allclose(scores[:50], [_walk(trees, row) for row in stats[:50]], rtol=1e-9)
    assert (quality.grow(stats, np.ones(2000)).score(stats) > 0.99).all()


# --- vector codes ---


def _plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = []
    for vec_id, vector, label in rows:
        if vector and len(vector) % parts == 0 and all(x is not None and math.isfinite(x) for x in vector):
            whole = [int(x) * 256 if abs(x) > 2**53 else math.floor(x * 256) for x in vector]
            kept.append((vec_id is None, vec_id or 0, vector, whole, label))
    kept.sort(key=lambda row: row[:3])
    if not kept:
        return []
    dims = len(kept[0][3])
    kept = [row for row in kept if len(row[3]) == dims]
    w = dims // parts
    cut = [[row[3][p * w : p * w + w] for p in range(parts)] for row in kept]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        taken = [[nearest(p, x[p])[1] for p in range(parts)] for x in cut]
        for p, e in product(range(parts), range(len(books[0]))):
            mine = [x[p] for x, t in zip(cut, taken) if t[p] == e]
            if mine:
                books[p][e] = [sum(column) // len(mine) for column in zip(*mine)]
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    out, labels = [], defaultdict(list)
    for row, x in zip(kept, cut):
        best = [nearest(p, x[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        error = error if error < 2**63 else None
        labels[row[4]].append(error)
        out.append((None if row[0] else row[1], "".join(f"{e:02x}" for _, e in best), error, row[4]))

    def total(label):
        errors = labels[label]
        return None if None in errors or sum(errors) >= 2**63 else sum(errors)

    return sorted(((i, code, error, total(label), digest) for i, code, error, label in out), key=repr)


def _vectors(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(i, v, label, "x", 1.5) for i, v, label in rows],
        f"vec_id long, embedding array<{kind}>, label int, code string, error double",
    )


def _coded(spark, tmp_path, rows, kind="float"):
    _vectors(spark, rows, kind).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return cases.rows_of(vector_codes.op13_vector_codes(spark, str(tmp_path)), *CODE)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_vector_codes_match_sql(spark, sf):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = cases.rows_of(vector_codes.op13_vector_codes(spark, sf), *CODE)
    assert got and got == cases.tuples(connection.sql(vector_codes.OP13_CHECK), *CODE)


def test_vector_codes_of_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    vector = lambda: [rng.choice([-0.5, 0.0, 0.25, 1 / 3, 2.0]) for _ in range(32)]
    rows = [(i, vector(), rng.choice([1, 2, None])) for i in range(150)]
    rows += [(5, vector(), 1), (5, rows[5][1], 1), (None, vector(), None), (None, vector(), 3)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.5] * 31, 1), (903, [0.5] * 48, 1), (904, [None] + [0.1] * 31, 1)]
    rows += [(905, [float("nan")] * 32, 1), (-9, [float("-inf")] + [0.0] * 31, 1)]
    assert _coded(spark, tmp_path, rows, "double") == _plain_codes(rows)


def test_vector_codes_of_few_rows_and_none(spark, tmp_path):
    rows = [(i, [float(i)] * 16, i % 2) for i in range(5)] + [(9, [2.5] * 16, None)]
    assert _coded(spark, tmp_path / "few", rows) == _plain_codes(rows)
    found, books = vector_codes.codes(_vectors(spark, []))
    assert books is None and found.count() == 0
    assert _coded(spark, tmp_path / "none", [(1, None, 1)]) == []


def test_vector_codes_of_huge_components(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 30) for _ in range(16)], i % 3) for i in range(90)]
    assert _coded(spark, tmp_path / "double", rows, "double") == _plain_codes(rows)
    # Every sum of squares fits, but not in the fast form's reach.
    rows = [(i, [float(rng.randint(-(1 << 20), 1 << 20)) for _ in range(16)], 0) for i in range(90)]
    assert _coded(spark, tmp_path / "float", rows) == _plain_codes(rows)


@pytest.mark.parametrize("spread", [2, 30, 4000])
def test_bounds_give_what_whole_comparisons_give(spread):
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread, (400, 4, 3))
    books = vector_codes.Codebooks.of(rng.integers(-spread, spread, (4, 40, 3)).astype(object))
    held, moves, least = None, None, 99
    for _ in range(8):
        held, squares = vector_codes.assign(x, books, moves, held)
        exact = ((x[:, :, None, :] - books.entries[None]) ** 2).sum(axis=3)
        np.testing.assert_array_equal(held.code.reshape(400, 4), exact.argmin(axis=2))
        np.testing.assert_array_equal(squares, exact.min(axis=2))
        flat = exact.reshape(1600, 40).astype(float)
        near = np.sqrt(np.take_along_axis(flat, held.near, 1))
        assert (held.lower <= near + 1e-3).all() and (np.diff(held.lower, axis=1) >= 0).all()
        rest = flat.copy()
        np.put_along_axis(rest, np.concatenate([held.code[:, None], held.near], axis=1), np.inf, 1)
        assert (held.outer <= np.sqrt(rest.min(axis=1)) + 1e-3).all()
        least = min(least, held.near.shape[1])
        moved = books.entries + rng.integers(-spread // 20 - 1, spread // 20 + 2, books.entries.shape)
        books, old = vector_codes.Codebooks.of(moved.astype(object)), books
        moves = books.moves(old)
    assert vector_codes.LEAST_BOUNDS <= least <= vector_codes.FIRST_BOUNDS
