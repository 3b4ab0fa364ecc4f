"""Toxicity, near duplicates, decontamination, archives and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import random

import cases
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from duesmith.llm import bitslices, decontamination, simhash, toxicity, warc
from duesmith.llm.components import components
from duesmith.sources.workspace import new_folder, stored


def _words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(n)]


def _auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    n = labels.sum()
    return (order[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.op4_toxicity(spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    assert _auc(both["score"].to_numpy(), both["toxic"].to_numpy()) > 0.9
    clean = both[both["toxic"] == 0]
    assert clean["predicted"].mean() < 0.05


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    scored = toxicity.toxicity(cases.documents(spark), labels)
    assert scored.count() == len(cases.ROWS)
    assert scored.where("score is null or score not between 0 and 1").count() == 0
    assert toxicity.toxicity(cases.nothing(spark), labels).count() == 0
    unlabelled = toxicity.toxicity(cases.documents(spark), labels.limit(0))
    assert {row["score"] for row in unlabelled.collect()} == {0.0}


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [row for row in cases.ROWS if row[0] is not None]
    for i in range(60):
        base = _words(rng, rng.choice([6, 40, 150]))
        for j in range(rng.randint(1, 4)):
            text = list(base)
            for _ in range(j):
                text[rng.randrange(len(text))] = "changed"
            rows.append((100 + 10 * i + j, " ".join(text)))
    docs = cases.documents(spark, rows)
    monkeypatch.setattr(simhash, "read_table", lambda *_: docs)
    got = simhash.op5_simhash(spark, "").collect()
    fps = [_fingerprint(text) for _, text in rows]
    of_fp = dict(zip(fps, _groups(fps, 4), strict=True))
    group = [of_fp[fp] for fp in fps]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, i), i)
    expected = sorted((i, f"{fp:016x}", least[g]) for (i, _), fp, g in zip(rows, fps, group, strict=True))
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == expected


def test_simhash_of_odd_rows(spark):
    assert simhash.near_groups(cases.documents(spark)).count() == len(cases.ROWS)
    assert simhash.near_groups(cases.nothing(spark)).count() == 0
    assert simhash.one_of_each(cases.nothing(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_slices_against_brute_force(radius):
    rng = random.Random(radius)
    fps = {0}
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    fps = sorted(fps, key=lambda fp: fp * 0x9E3779B97F4A7C15 % (1 << 64))
    column = np.array(fps, np.uint64)[:, None]
    expected = _groups(fps, radius)

    def same(roots):
        first = {}
        return [first.setdefault(root, i) for i, root in enumerate(roots)]

    assert same(bitslices.linked(column, np.full(len(fps), len(fps)), radius).tolist()) == same(expected)
    assert same(bitslices.linked_by_search(column, radius).tolist()) == same(expected)
    wide = np.concatenate([column, column, column], axis=1)
    assert same(bitslices.linked(wide, np.full(len(fps), len(fps)), 3 * radius).tolist()) == same(expected)


def test_every_link_lies_in_a_bucket():
    rng = random.Random(9)
    for n in (10, 10**6, 10**9, 10**12):
        blocks = simhash.blocks_for(n, 4)
        masks = [mask % (1 << 64) for mask in simhash.block_masks(blocks, 4)]
        for _ in range(200):
            differ = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(mask & differ == 0 for mask in masks)


def test_similar_texts_leave_one(spark):
    rng = random.Random(6)
    rows, bases = list(cases.ROWS), []
    for i in range(30):
        base = _words(rng, 200)
        bases.append(base)
        for j in range(4):
            text = list(base)
            for _ in range(j and 2):
                text[rng.randrange(len(text))] = "changed"
            rows.append((100 + 10 * i + j, " ".join(text)))
    docs = cases.documents(spark, rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [row["doc_id"] for row in kept.select("doc_id").collect()]
    assert [i for i in ids if i is not None and i >= 100] == [] or sorted(
        i for i in ids if i is not None and i >= 100
    ) == [100 + 10 * i for i in range(30)]
    assert {1, 3, 6, 7, 8} <= set(ids) and ids.count(None) == 1


def test_similar_groups_against_exact_shares(spark):
    rng = random.Random(15)
    rows = []
    for i in range(150):  # changed words, near the threshold on both sides
        n = rng.choice([5, 9, 40, 200, 400])
        base = _words(rng, n)
        for j in range(3):
            text = list(base)
            for at in rng.sample(range(n), min(n, round(j * n * rng.uniform(0.01, 0.045)))):
                text[at] = f"changed{i}x{j}"
            rows.append((10 * i + j, " ".join(text)))
    long = _words(rng, 100)
    rows += [(9000, " ".join(long)), (9001, " ".join([*long, *long[40:64] * 6]))]
    sets = []
    for _, text in rows:
        words = text.split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))})
    least = list(range(len(rows)))
    for b in range(len(rows)):
        for a in range(b):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((least[a], least[b]))
                least = [low if x == high else x for x in least]
    kept = simhash.one_of_each(cases.documents(spark, rows)).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({rows[x][0] for x in least})


def test_one_of_linked_fingerprints_against_brute_force(spark):
    rng = random.Random(21)
    rows = list(cases.ROWS)
    for i in range(60):
        base = _words(rng, rng.choice([30, 400, 900]))
        for j in range(4):
            text = list(base)
            for at in rng.sample(range(len(text)), j and rng.randint(1, 3)):
                text[at] = f"changed{j}"
            rows.append((100 + 10 * i + j, " ".join(text)))
    marks = [_fingerprint(text) for _, text in rows]
    least = list(range(len(rows)))
    for b in range(len(rows)):
        for a in range(b):
            if (marks[a] ^ marks[b]).bit_count() <= 4:
                low, high = sorted((least[a], least[b]))
                least = [low if x == high else x for x in least]
    groups: dict[int, list] = {}
    for (doc_id, _), root in zip(rows, least):
        groups.setdefault(root, []).append((doc_id is None, doc_id or 0))
    docs = cases.documents(spark, rows)
    kept = simhash.one_of_near(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.select("doc_id").collect())
    assert got == sorted(min(group) for group in groups.values())
    assert simhash.one_of_near(cases.nothing(spark)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 200), (200, 250)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {row["node"]: row["root"] for row in found.collect()}
    expected = {i: 0 for i in range(51)} | {100 + i: 100 for i in range(40)} | dict.fromkeys((200, 250, 300), 200)
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def leaky(spark):
    rng = random.Random(8)
    items = [(i, " ".join(_words(rng, rng.choice([16, 30, 60, 150])))) for i in range(40)]
    rows, planted = list(cases.ROWS), set()
    for i in range(200):
        text = _words(rng, rng.randint(20, 300))
        if i < 120:
            item = items[i % 40][1].split()
            if i % 3 == 1:
                item = [w.upper() for w in item]
            if i % 3 == 2:  # a paraphrase: every sixth word differs
                item = ["other" if k % 6 == 5 else w for k, w in enumerate(item)]
            at = rng.randint(0, len(text))
            text[at:at] = item
            planted.add((1000 + i, i % 40))
        rows.append((1000 + i, " ".join(text)))
    return cases.documents(spark, rows), spark.createDataFrame([*items, (98, None), (99, "")], "item_id long, text string"), planted


def test_leaks_are_found_and_clean_documents_are_not(leaky):
    docs, benchmark, planted = leaky
    found = decontamination.leaks(docs, benchmark).collect()
    assert {(row["doc_id"], row["item_id"]) for row in found} == planted
    assert all(0 < row["cosine"] <= 1 and 0.5 <= row["lcs_share"] <= 1 for row in found)
    clean = decontamination.clean_rows(docs, benchmark)
    assert clean.columns == docs.columns
    leaked = {doc_id for doc_id, _ in planted}
    expected = sorted((repr(r["doc_id"]) for r in docs.collect() if r["doc_id"] not in leaked))
    assert sorted(repr(r["doc_id"]) for r in clean.collect()) == expected


def test_leaks_over_several_blocks_of_items(leaky, monkeypatch):
    docs, benchmark, planted = leaky
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 15)
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, benchmark).collect()} == planted


def test_copies_of_more_passages_than_the_rank_are_found(spark):
    rng = random.Random(13)
    vocabulary = _words(rng, 4000)
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(18, 40)))) for i in range(1000)]
    items.append((1000, " ".join(rng.choices(vocabulary, k=64 * 300))))
    rows = []
    for i, (_, text) in enumerate(items[:1000]):
        rows.append((i, " ".join([*rng.choices(vocabulary, k=60), text, *rng.choices(vocabulary, k=60)])))
    rows.append((1000, items[1000][1]))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(cases.documents(spark, rows), benchmark).collect()}
    assert found >= {(i, i) for i in range(1001)}


def test_short_items_in_a_third_of_the_documents_are_found(spark):
    rng = random.Random(14)
    items = [(i, " ".join(_words(rng, n))) for i, n in enumerate([5, 15, 16, 15, 24])]
    rows = []
    for i in range(600):
        text = _words(rng, rng.randint(60, 150))
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = items[i // 3 % 5][1].split()
        rows.append((i, " ".join(text)))
    # Every word of the items is in a third of the documents.
    everything = " ".join(text for _, text in items).split()
    for i in range(200):
        rows.append((1000 + i, " ".join(w for x in rng.sample(everything, len(everything)) for w in (x, *_words(rng, 2)))))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(cases.documents(spark, rows), benchmark).collect()}
    assert {x for x in found if x[0] < 1000} == {(i, i // 3 % 5) for i in range(0, 600, 3)}


def test_leaks_of_nothing(spark, leaky):
    docs, benchmark, _ = leaky
    assert decontamination.leaks(cases.nothing(spark), benchmark).count() == 0
    assert decontamination.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontamination.clean_rows(docs, benchmark.limit(0)).count() == docs.count()


def test_answer_decides_between_paraphrases(spark):
    rng = random.Random(2)
    item, answer = _words(rng, 40), _words(rng, 3)
    half = [w if k < 24 else f"new{k}" for k, w in enumerate(item)]
    docs = cases.documents(spark, [(1, " ".join(half)), (2, " ".join([*half, *answer]))])
    benchmark = spark.createDataFrame([(5, " ".join(item), " ".join(answer))], "item_id long, text string, answer string")
    assert [r["doc_id"] for r in decontamination.leaks(docs, benchmark).collect()] == [2]


def test_words_strewn_over_a_document_are_no_leak(spark):
    rng = random.Random(5)
    item, short = _words(rng, 20), _words(rng, 4)
    strewn = [w for x in item for w in (x, "far", "from", "it")]
    docs = cases.documents(
        spark, [(1, " ".join(strewn)), (2, " ".join([*short[:2], "gap", *short[2:]])), (3, " ".join(["so", *short, "on"]))]
    )
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short))], "item_id int, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, benchmark).collect()] == [(3, 2)]


def test_latent_search_recall_against_exact_cosines(spark):
    """Every 20th passage's own words as a benchmark: each must be found again."""
    rows = cases.duck("SELECT doc_id, text FROM documents").fetchall()
    items = []
    for i, text in rows:
        words = text.split()
        if i % 20 == 0 and len(words) >= 60:
            items.append((i, " ".join(words[10:50])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert sum((i, i) in pairs for i, _ in items) >= 0.9 * len(items)


def test_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(a, tuple(b)) == table[-1][-1]


PAGES = [
    (1, "http://b.example.org/x?y=1", "<p>same</p>"),
    (2, "http://www.a.example.org/", "<p>same</p>"),
    (9, "http://a.example.org/", "<p>same</p>"),
    (3, None, None),
    (4, "not a url \r\n at all", ""),
    (5, "http://a.example.org/", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 50),
    (6, "http://a.example.org/é", "日本 😀\r\n\r\n\r\n"),
    (7, "http://a.example.org/", "z" * 300_000),
    (8, "http://[bad", "one"),
    (8, "http://[bad", "one"),
    (None, "http://nobody.example/", "lone"),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, file string, latest string")
    path = new_folder(spark, "archives")
    got = warc.archive(pages, path).collect()
    latest = {}
    for i, _, html in PAGES:
        latest[html or ""] = max(latest.get(html or "", -1), -1 if i is None else i)
    expected = []
    for i, _, html in PAGES:
        payload = (html or "").encode()
        again = latest[html or ""] not in (-1, i)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected.append((i, len(payload), digest, "revisit" if again else "response", latest[html or ""] if again else None))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(expected, key=repr)
    keys = [(r["url_key"], r["captured"]) for r in got]
    assert keys == sorted(keys)
    texts = warc.read_archives(spark, f"{path}/warc", with_payload=True).where("record_type = 'response'").collect()
    assert sorted(r["html"] for r in texts) == sorted([latest_html for _, latest_html in [(i, h or "") for i, _, h in PAGES if i in (9, 4, 5, 6, 7, 8, None)]])
    assert warc.archive(pages.limit(0), new_folder(spark, "archives")).count() == 0


def test_loser_tree_merges_runs():
    rng = random.Random(1)
    for k in range(10):
        runs = [sorted((rng.randint(0, 50), i) for _ in range(rng.randint(0, 9))) for i in range(k)]
        assert list(warc.LoserTree([iter(run) for run in runs])) == sorted(x for run in runs for x in run)


def _pipeline_docs(spark, tmp_path):
    rng = random.Random(12)
    insults = _words(rng, 5)
    rows, labels, role = [], [], {}
    item = " ".join(_words(rng, 40))
    for i in range(600):
        text = _words(rng, 120)
        kind = "toxic" if i % 6 == 0 else "clean"
        if kind == "toxic":
            text[10:10], text[50:50] = insults, insults
        rows.append((i, " ".join(text)))
        role[i] = kind
        if i < 400:
            labels.append((i, int(kind == "toxic")))
    for j, i in enumerate(k for k in range(601, 700) if k % 6):
        base = rows[[1, 2, 3, 5][j % 4]][1].split()
        text = list(base)
        role[i] = "copy"
        if j % 2:
            text[j % 100] = "changed"
            role[i] = "changed"
        rows.append((i, " ".join(text)))
    # The stage goes by its operator's contract: links of at most 4 bits, and what they lead to.
    left = {i: _fingerprint(text) for i, text in rows if role[i] == "changed" or i in (1, 2, 3, 5)}
    while left:
        first = min(left)  # of a group the smallest id stays
        group, open_ = [], [first]
        while open_:
            group.append(i := open_.pop())
            mark = left.pop(i, None)
            open_ += [j for j, other in left.items() if (mark ^ other).bit_count() <= 4 and j not in open_]
        role |= {i: "clean" if i == first else "near" for i in group}
    for i in range(700, 710):
        rows.append((i, " ".join([*_words(rng, 80), item, *_words(rng, 30)])))
        role[i] = "leak"
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return cases.documents(spark, rows), role


def test_pipeline_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    docs, role = _pipeline_docs(spark, tmp_path)
    columns = docs.columns
    assert list(role.values()).count("near") >= 5
    removed = {"toxicity": "toxic", "exact_dedup": "copy", "near_dedup": "near", "decontamination": "leak"}
    gone = set()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
        ids = {row["doc_id"] for row in docs.select("doc_id").collect()}
        gone.add(removed[name])
        assert ids == {i for i, kind in role.items() if kind not in gone}, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {row["doc_id"] for row in pieces.collect()} == ids


def test_pipeline_of_odd_and_of_no_rows(spark, tmp_path):
    _pipeline_docs(spark, tmp_path)
    for docs in (cases.documents(spark), cases.nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), name)
        assert (docs.count() > 0) == (docs.where("doc_id = 1").count() > 0)


def test_latent_space_is_fitted_on_all_passages(spark):
    rng = random.Random(21)
    vocabulary = _words(rng, 60)
    skewed = [1 / (k + 1) for k in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, skewed, k=rng.choice([0, 5, 70, 40])))) for i in range(3000)]
    late = _words(rng, 20)  # words that only the last passage of a long document has
    rows.append((3000, " ".join(rng.choices(vocabulary, skewed, k=3200) + late)))
    docs = cases.documents(spark, [*rows, (3001, None)])
    benchmark = spark.createDataFrame([(1, " ".join(vocabulary)), (2, " ".join(late))], "item_id long, text string")
    (shared,) = decontamination._blocks(docs, benchmark)
    ((queries, space, _),) = shared.value

    # The same matrix, passage by passage.
    bucket = {w: h[0] >> (64 - decontamination.BITS) for w in [*vocabulary, *late] for h in decontamination._hashed([w])}
    n, size = len(rows) + 1, decontamination.PASSAGE
    gram = decontamination.ITEM_WEIGHT**2 * space.vectors.T.astype(float) @ space.vectors
    for _, text in rows:
        words = text.split()
        parts = [words[a : a + size] for a in range(0, len(words), size)]
        for part in parts:
            x = np.zeros(len(gram))
            np.add.at(x, [space.row[bucket[w]] for w in part], [space.idf[bucket[w]] for w in part])
            x /= np.linalg.norm(x)
            gram += min(1, decontamination.DOCUMENTS_WEIGHT / n) / len(parts) * np.outer(x, x)
    sizes = np.linalg.eigvalsh(gram)
    basis = space.basis.astype(float)
    assert basis.shape[1] == len(gram)
    assert np.allclose(np.diag(basis.T @ gram @ basis), sizes[::-1], rtol=1e-3, atol=1e-3)
    passages = decontamination.all_passages(docs, n, space.idf.astype(float), space.row >= 0).collect()
    assert sum(len(row["at"]) for row in passages) // 4 == sum(len(text.split()) for _, text in rows)
