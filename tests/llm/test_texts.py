"""Exact dedup, substring dedup and token counts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import cases
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from duesmith.llm import exact_dedup, packing, pieces, substring_dedup, token_counts, words

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DEDUP = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
CUT = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_exact_dedup_matches_sql(spark):
    got = cases.rows_of(exact_dedup.op1_exact_dedup(spark, cases.SMALL), *DEDUP)
    assert got == cases.tuples(cases.duck(exact_dedup.OP1_CHECK), *DEDUP)


def test_exact_dedup_of_hot_groups_over_many_buckets(spark):
    rows = [(i, "hot text") for i in range(400)] + [(1000 + i, f"text {i // 3}") for i in range(300)]
    got = cases.rows_of(exact_dedup.equal_texts(cases.documents(spark, rows)), *DEDUP)
    assert got == cases.tuples(cases.duck(exact_dedup.OP1_CHECK, documents=rows), *DEDUP)


def test_exact_dedup_of_odd_rows(spark):
    got = [tuple(r) for r in exact_dedup.equal_texts(cases.documents(spark)).select(*DEDUP).collect()]
    assert len(got) == len(cases.ROWS)
    digests = Counter(
        hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest() for _, text in cases.ROWS
    )
    assert Counter(row[4] for row in got) == digests
    assert all(row[2] == digests[row[4]] for row in got)
    kept = Counter(row[4] for row in got if row[3])
    assert kept == Counter(list(digests))  # exactly one of each group, of repeated rows too
    assert {row[1] for row in got if row[4] == hashlib.sha256(b"").hexdigest()} == {3}


def test_keep_first_keeps_whole_rows(spark):
    docs = cases.documents(spark)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert cases.rows_of(kept, "doc_id", "text") == sorted(
        [(1, cases.ROWS[0][1]), (3, None), (5, " \n\t "), (6, cases.LONG), (None, "a text without a number"),
         (7, "the same row twice"), (7, "another text under the same number"), cases.ROWS[11]], key=repr,
    )
    assert exact_dedup.keep_first(cases.nothing(spark)).count() == 0
    assert exact_dedup.equal_texts(cases.nothing(spark)).count() == 0


def test_substring_dedup_matches_sql(spark):
    got = cases.rows_of(substring_dedup.op6_substring_dedup(spark, cases.SMALL), *CUT)
    assert got == cases.tuples(cases.duck(substring_dedup.OP6_CHECK), *CUT)


def _brute_repeats(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    starts = Counter(tuple(w[s : s + window]) for w in split for s in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, split, strict=True):
        gone = {
            p for s in range(len(w) - window + 1) if starts[tuple(w[s : s + window])] > 1 for p in range(s, s + window)
        }
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((doc_id, len(w), len(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_against_brute_force(spark, seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = list(cases.ROWS)
    for i in range(120):
        text = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            at, low, high = rng.randint(0, len(text)), rng.randint(0, 20), rng.randint(30, 60)
            text[at:at] = passage[low:high]
        if i % 10 == 0:
            text += ["again"] * rng.randint(5, 40)
        rows.append((100 + i, " ".join(text)))
    got = substring_dedup.without_repeats(cases.documents(spark, rows), window=12, run=4)
    assert cases.rows_of(got, "doc_id", "n_words", "n_removed", "kept") == _brute_repeats(rows, 12)


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.without_repeats(cases.nothing(spark)).count() == 0


def test_pre_tokens_against_the_library():
    rng = random.Random(1)
    parts = ["'", "s", "t", "re", "'ve", "'ll", "'d", " ", "  ", "\n", "\t", "\xa0", "　", "a", "B", "é", "1", "²",
             "!", "...", "m", "_", "\x1c", "\x85", "<|endoftext|>", "日本", "ا", "𝒳", "😀", "​", "́"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(20_000)]
    encoder = pieces.PieceEncoder(TOKENIZER, pieces.prove_whole_tokens(TOKENIZER))
    expected = [e.ids for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.ids(texts)] == expected
    assert encoder.counts(texts) == [len(ids) for ids in expected]


def test_a_full_table_of_pre_tokens_is_emptied(monkeypatch):
    whole = pieces.prove_whole_tokens(TOKENIZER)
    monkeypatch.setattr(pieces, "SLOTS_LOG2", 17)
    encoder = pieces.PieceEncoder(TOKENIZER, whole)
    texts = [f"zq{i:06d}xv{i}" for i in range(30_000)]
    expected = [e.ids for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for i in range(0, 30_000, 5000) for ids in encoder.ids(texts[i : i + 5000])] == expected


def test_token_counts(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)

    def expected(rows):
        counts = [len(tokenizer.encode(text or "", add_special_tokens=False).ids) for _, text in rows]
        return sorted(
            [(i, len((text or "").encode()), n) for (i, text), n in zip(rows, counts, strict=True)], key=repr
        )

    columns = ("doc_id", "n_bytes", "n_tokens")
    assert cases.rows_of(token_counts.token_counts(cases.documents(spark), TOKENIZER), *columns) == expected(cases.ROWS)
    rows = cases.duck("SELECT doc_id, text FROM documents").fetchall()
    got = token_counts.op7_token_counts(spark, cases.SMALL)
    assert cases.rows_of(got, *columns) == expected(rows)
    assert got.where("over_limit <> (n_tokens > 512)").count() == 0
    assert token_counts.token_counts(cases.nothing(spark), TOKENIZER).count() == 0


def _best_fit(lengths, capacity):
    """Piece by piece: the fullest sequence that still has room."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [space for space in room if space >= length]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - length)
        else:
            room.append(capacity - length)
    return len(room)


@pytest.mark.parametrize("seed", range(20))
def test_planning_on_counts_equals_best_fit_on_pieces(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
    plan = packing.plan_sequences(dict(Counter(lengths)), capacity)
    taken = {}
    for length, n in Counter(lengths).items():
        slots = plan[length]
        for slot, (first, each, sequence, offset) in enumerate(slots):
            last = slots[slot + 1][0] if slot + 1 < len(slots) else n
            for turn in range(last - first):
                place = offset + turn % each * length
                taken.setdefault(sequence + turn // each, []).append((place, place + length))
    for spans in taken.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= capacity
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sum(map(len, taken.values())) == len(lengths)
    assert len(taken) == _best_fit(lengths, capacity)


def test_packing_round_trip(spark):
    docs = cases.documents(spark, [*cases.ROWS, (9, "word " * 5000)])
    packed = packing.pack(packing.stored(packing.token_pieces(docs, TOKENIZER, 256, with_ids=True), "pieces"), 256)
    rows = packed.collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = Counter(
        tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (0,) for _, text in [*cases.ROWS, (9, "word " * 5000)]
    )
    whole = {row["sequence_id"]: row["ids"] for row in packing.packed_sequences(packed).collect()}
    assert all(len(ids) <= 256 for ids in whole.values())
    for row in rows:
        assert whole[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]] == row["ids"]
        assert row["piece"] == 0 or row["length"] == 256
    found = Counter()
    texts = {}
    for row in rows:
        texts.setdefault((row["doc_id"], row["piece"] == 0 and row["length"]), []).append(row)
    for doc_id in {row["doc_id"] for row in rows} - {None, 7}:
        own = sorted((row for row in rows if row["doc_id"] == doc_id), key=lambda row: row["piece"])
        assert [row["start"] for row in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        found[tuple(i for row in own for i in row["ids"])] += 1
    assert not found - expected
    assert packing.pack(packing.stored(packing.token_pieces(cases.nothing(spark), TOKENIZER), "pieces")).count() == 0


def test_packing_query(spark):
    from zlib import crc32

    import numpy as np

    rows = packing.op3_packing(spark, cases.SMALL).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = set()
    for doc_id, text in cases.duck("SELECT doc_id, text FROM documents").fetchall():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        begin, end, piece = 0, (len(ids) - 1) % 2048 + 1, 0
        while begin < len(ids):
            part = ids[begin:end]
            expected.add((doc_id, piece, begin, len(part), crc32(np.array(part, "<u4").tobytes())))
            begin, end, piece = end, end + 2048, piece + 1
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    assert len(rows) == len(expected)
    in_order = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    filled = {}
    for row in in_order:
        assert row["offset"] == filled.get(row["sequence_id"], 0)
        filled[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(filled.values()) <= 2048


def test_words_of_a_sliced_column():
    texts = ["", None, "a b", "  x\ty ", "É Ü", "日本 語", None, "", "z"] * 40
    for column in (pa.array(texts), pa.array(texts).slice(3, 100), pa.array([], pa.string()), pa.array([None], pa.string())):
        got = []
        for found in words.words_of(column):
            data = found.data.tobytes()
            for i in range(len(found.cuts) - 1):
                places = range(found.cuts[i], found.cuts[i + 1])
                got.append([data[found.starts[j] : found.ends[j]].decode() for j in places])
        assert got == [re.findall(r"[^\x20\x09-\x0D]+", text or "") for text in column.to_pylist()]
