"""Substring dedup by relative Lempel-Ziv parsing.

Every text is parsed from left to right into factors.  A factor ends where the smallest hash among
the short word runs inside a window changes: such an anchor depends only on the window's words, so
equal windows always lie in factors with the same anchor, wherever they occur.  All factors of all
documents are the reference, indexed in blocks by anchor.

* A factor whose whole word sequence is in its block more than once is a duplicate span at once.
* Where a block holds several different factors, they may still share windows, at the borders of
  a copied passage or around a changed word.  There one copy of each different factor is compared
  window by window.

Both steps are sums over keys with partial aggregation, so a passage that very many documents share
is one row for each task before it moves, and joins that can be split.  Sequences are compared as
two 64-bit hashes (anchor and content).

Null and empty texts have no words.  A document is known by its id and a hash of its text, so null
and repeated ids do not mix up documents; rows that agree in both are copies of each other.  An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith.llm.common import id_and_text, read_table, ship_code
from duesmith.llm.words import Words, range_hashes, words_of
from duesmith.sources.workspace import stored

WINDOW = 35
#: Words of the runs among which a window's anchor is chosen.
RUN = 8


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` neighbours, the first one of equals."""
    n = len(values) - width + 1
    place, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = place[:-step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        size += step
    return place[:n]


def _factors(words: Words, window: int, run: int) -> tuple[np.ndarray, ...]:
    """Text, first window and number of windows of each factor, then its anchor and content hash."""
    h, text = words.hashes, words.text_of
    if len(h) < window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    at = np.arange(len(h) - run + 1)
    runs = range_hashes(h, at, at + run)
    anchor = _leftmost_least(runs, window - run + 1)
    inside = text[: len(anchor)] == text[window - 1 :]
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    begins = np.flatnonzero(new)
    stops = inside.copy()
    stops[:-1] &= (anchor[1:] != anchor[:-1]) | ~inside[1:]
    ends = np.flatnonzero(stops) + 1
    content = range_hashes(h, begins, ends + window - 1)
    return text[begins], begins - words.cuts[text[begins]], ends - begins, runs[anchor[begins]], content


def _keyed(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")


def factors(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``row_key, start, n_windows, anchor, content`` of every factor of every text."""
    ship_code(docs.sparkSession)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for words in words_of(batch.column("text")):
                text, start, number, anchor, content = _factors(words, window, run)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[words.first + text]),
                        pa.array(start.astype(np.int32)),
                        pa.array(number.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                    ],
                    ["row_key", "start", "n_windows", "anchor", "content"],
                )

    return _keyed(docs).select("row_key", "text").mapInArrow(
        parse, "row_key bigint, start int, n_windows int, anchor bigint, content bigint"
    )


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """``anchor, seen, row_key, start`` of every window of the factors listed in ``wanted``."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            wanted = batch.column("wanted")
            for words in words_of(batch.column("text")):
                n = len(words.cuts) - 1
                lists = wanted.slice(words.first, n)
                flat = lists.flatten()
                of = np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False))
                start, number = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n_windows"))
                factor = np.repeat(np.arange(len(of)), number)
                place = start[factor] + np.arange(len(factor)) - np.repeat(np.cumsum(number) - number, number)
                begin = words.cuts[of[factor]] + place
                yield pa.RecordBatch.from_arrays(
                    [
                        flat.field("anchor").take(pa.array(factor)),
                        pa.array(range_hashes(words.hashes, begin, begin + window).view(np.int64)),
                        pa.array(keys[words.first + of[factor]]),
                        pa.array(place.astype(np.int32)),
                    ],
                    ["anchor", "seen", "row_key", "start"],
                )

    return texts.mapInArrow(look, "anchor bigint, seen bigint, row_key bigint, start int")


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``row_key, start, n_windows``: runs of windows whose words also start anywhere else."""
    parsed = stored(factors(docs, window, run), "factors")
    # Key lists are stored before they are joined: a join of two plain shuffles can split a hot key.
    shared = stored(parsed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    known = stored(parsed.join(shared, "anchor", "left_semi"), "shared-factors")

    contents = known.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("row_key", "start", "n_windows")).alias("one")
    )
    contents = stored(contents, "contents")
    several = stored(contents.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "several")
    compared = (
        contents.join(several, "anchor", "left_semi")
        .groupBy("one.row_key")
        .agg(F.collect_list(F.struct("one.start", "one.n_windows", "anchor")).alias("wanted"))
    )
    texts = _keyed(docs).dropDuplicates(["row_key"]).join(compared, "row_key")
    windows = stored(_windows(texts.select("row_key", "wanted", "text"), window), "windows")
    twice = windows.groupBy("anchor", "seen").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "seen")
    twice = stored(twice, "twice")
    at_borders = windows.join(twice, ["anchor", "seen"], "left_semi").select(
        "row_key", "start", F.lit(1).alias("n_windows")
    )
    whole = known.join(contents.where("copies > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    return whole.select("row_key", "start", "n_windows").unionAll(at_borders)


def without_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words that stay, joined by a space) of every document."""
    spark = docs.sparkSession
    spans = repeated_spans(docs, window, run)
    spans = spans.groupBy("row_key").agg(F.collect_list(F.struct("start", "n_windows")).alias("spans"))
    spans = stored(spans, "spans")
    ship_code(spark)
    rows = _keyed(docs).join(spans, "row_key", "left").select("doc_id", "text", "spans")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_buffer().to_pybytes().split()
                kept = words
                if found.is_valid:
                    spans = found.values
                    begin = spans.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
                    number = spans.field("n_windows").to_numpy(zero_copy_only=False)
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, begin, 1)
                    np.add.at(depth, begin + number + window - 1, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")))
            n_words, n_removed, kept_text = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept_text, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return rows.mapInArrow(remove, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_CHECK = r"""
WITH split AS (
  SELECT doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), starts AS (
  SELECT doc_id, s, md5(array_to_string(words[s:s + 34], ' ')) AS seen
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS s FROM split)
), twice AS (
  SELECT seen FROM starts GROUP BY seen HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(generate_series(s, s + 34)) AS place FROM starts SEMI JOIN twice USING (seen)
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM split
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS body
  FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id,
       CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""
