"""Hashes of words, ranges and pre-tokens: no pattern of letters makes different ones meet."""

from __future__ import annotations

import cases
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from duesmith.llm import decontamination, pieces, substring_dedup, token_counts, words

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _thue_morse(n, zero, one):
    first = "".join(one if bin(i).count("1") % 2 else zero for i in range(n))
    return first, "".join(zero if c == one else one for c in first)


@pytest.mark.parametrize("size", [16, 64, 100, 128, 129, 1024, 2048, 4096])
def test_words_that_differ_have_hashes_that_differ(size):
    pair = _thue_morse(size, "a", "b")
    texts = [*pair, *[pair[0][:i] + "c" + pair[0][i + 1 :] for i in range(0, size, 7)], pair[0] + "a", pair[0][:-1]]
    (found,) = words.words_of(pa.array([" ".join(texts)]), portion=1 << 24)
    assert len(set(found.hashes.tolist())) == len(texts)
    (again,) = words.words_of(pa.array([" ".join(["x", *texts])]), portion=1 << 24)
    assert again.hashes[1:].tolist() == found.hashes.tolist()  # wherever a word stands


def test_short_words_are_told_apart():
    every = [bytes([a, b]).decode("latin1") for a in range(97, 123) for b in range(97, 123)]
    every += [w * k for w in "abc" for k in range(1, 40)] + ["\x01", "\x01\x01", "a\x00", "\x00a", "\x00"]
    hashes = np.concatenate([w.hashes for w in words.words_of(pa.array([" ".join(sorted(set(every)))]))])
    assert len(set(hashes.tolist())) == len(set(every))


def test_ranges_of_two_words_in_any_pattern():
    (found,) = words.words_of(pa.array(["yes no"]))
    order = [np.array([int(c) for c in text]) for text in _thue_morse(4096, "0", "1")]
    sequence = np.concatenate([found.hashes[o] for o in order])
    starts, ends = np.array([0, 4096, 0, 1]), np.array([4096, 8192, 4095, 4096])
    assert len(set(words.range_hashes(sequence, starts, ends).tolist())) == 4
    same = np.concatenate([sequence[:4096], found.hashes[:1], sequence[:4096]])
    a, b = words.range_hashes(same, np.array([0, 4097]), np.array([4096, 8193])).tolist()
    assert a == b


@pytest.mark.parametrize("letters", ["ab", "nz", "日本"])
@pytest.mark.parametrize("size", [1024, 4096])
def test_tokens_of_such_words_match_the_library(letters, size):
    texts = list(_thue_morse(size, *letters))
    tokenizer = Tokenizer.from_file(TOKENIZER)
    mine = pieces.PieceEncoder(TOKENIZER, pieces.prove_whole_tokens(TOKENIZER))
    for text in [*texts, " ".join(texts)]:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert mine.counts([text]) == [len(expected)]
        assert mine.ids([text])[0].tolist() == expected


def test_token_counts_of_such_words_in_spark(spark):
    rows = list(enumerate(_thue_morse(1024, "a", "b")))
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = cases.rows_of(token_counts.token_counts(cases.documents(spark, rows), TOKENIZER), "doc_id", "n_tokens")
    assert got == [(i, len(tokenizer.encode(text, add_special_tokens=False).ids)) for i, text in rows]


def test_windows_that_differ_in_such_a_word_are_no_repeats(spark):
    one, two = _thue_morse(1024, "a", "b")
    text = lambda word: " ".join([f"w{i}" for i in range(20)] + [word] + [f"v{i}" for i in range(20)])
    rows = [(1, text(one)), (2, text(two)), (3, text("other"))]
    got = substring_dedup.without_repeats(cases.documents(spark, rows))
    assert {row["n_removed"] for row in got.collect()} == {0}
    twice = substring_dedup.without_repeats(cases.documents(spark, [*rows, (4, text(two))]))
    assert cases.rows_of(twice, "doc_id", "n_removed") == [(1, 0), (2, 41), (3, 0), (4, 41)]


def test_a_benchmark_of_such_words_is_found_where_it_stands(spark):
    one, two = _thue_morse(1024, "a", "b")
    around = [f"w{i}" for i in range(9)]
    benchmark = spark.createDataFrame([(1, " ".join([*around, one]))], "item_id long, text string")
    rows = [(1, " ".join(["start", *around, one, "end"])), (2, " ".join(["start", two] * 12))]
    found = decontamination.leaks(cases.documents(spark, rows), benchmark).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 1)]
