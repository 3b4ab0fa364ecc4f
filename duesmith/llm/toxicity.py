"""Toxicity scores by FTRL-proximal logistic regression on hashed word n-grams and skip-grams.

Learning takes a bounded sample of labelled rows (``MOST_LABELS``), dealt to tasks that
each run FTRL-proximal with rates of their own for every coordinate; L1 leaves few weights, which
are averaged over the shards.  Their number is bounded by the number of hash buckets, so they
travel with the scoring function.  Scoring is one scan of whole texts, without a shuffle.

Features are presence of words, pairs of neighbours and pairs with one word between, lower-cased,
punctuation aside.  Null and empty texts get the score of the bias alone; without usable labels
every score is 0.  Null or repeated ids are scored row by row; an empty table gives no rows.
``score_rows`` keeps all other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duesmith.llm.common import read_table, ship_code
from duesmith.llm.words import NOT_ALNUM, Words, mix, words_of
from duesmith.sources.workspace import stored

#: Labelled rows that learning takes at most.
MOST_LABELS = 24_000
#: Of these, rows that one task learns from.
SHARD_LABELS = 8_000
BITS = 20
BIAS = 1 << BITS
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 12.0, 0.1


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash bucket of each feature, repeats included."""
    h, text = words.hashes, words.text_of
    parts = [(text, h)]
    for gap, salt in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F)):
        if len(h) > gap:
            same = text[gap:] == text[:-gap]
            parts.append((text[gap:][same], mix(h[:-gap] * np.uint64(salt) + h[gap:])[same]))
    buckets = np.concatenate([p[1] for p in parts]) >> np.uint64(64 - BITS)
    return np.concatenate([p[0] for p in parts]), buckets.astype(np.int64)


def _present(text: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without repeats, in order of text."""
    both = np.unique((text << BITS) | bucket)
    return both >> BITS, both & (BIAS - 1)


class Ftrl:
    """FTRL-proximal on sparse presence features; the last coordinate is the bias, free of L1."""

    def __init__(self) -> None:
        self.z = np.zeros(BIAS + 1)
        self.n = np.zeros(BIAS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == BIAS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples: list[tuple[np.ndarray, int]] = []
    for batch in batches:
        labels = batch.column("toxic").to_numpy(zero_copy_only=False)
        for words in words_of(batch.column("text"), NOT_ALNUM, lower=True):
            text, bucket = _present(*_features(words))
            cuts = np.searchsorted(text, np.arange(len(words.cuts)))
            for i in range(len(words.cuts) - 1):
                at = np.append(bucket[cuts[i] : cuts[i + 1]], BIAS).astype(np.int32)
                examples.append((at, int(labels[words.first + i])))
    model = Ftrl()
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(examples)):
            model.learn(*examples[i])
    every = np.arange(BIAS + 1)
    w = model.weights(every)
    at = every[(w != 0) | (every == BIAS)] if examples else every[:0]
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["i", "w"])


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights from the labelled rows that are not held out."""
    ship_code(docs.sparkSession)
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = stored(chosen, "chosen-labels")
    shards = max(1, -(-chosen.count() // SHARD_LABELS))
    # At most ``most`` pairs of an id and a label.
    shown = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    dealt = shown.repartitionById(shards, shard).sortWithinPartitions("doc_id", "text")
    weights = (
        dealt.select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(_train, "i bigint, w double")
        .groupBy("i")
        .agg(F.sum("w").alias("w"))
        .orderBy("i")
        .toPandas()  # at most one row for each hash bucket
    )
    return weights["i"].to_numpy(np.int64), weights["w"].to_numpy(np.float64) / shards


def held_out(id_column: str) -> Column:
    """Rows whose label learning never sees."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def score_rows(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], out: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score in a column named ``out``."""
    ship_code(docs.sparkSession)
    at, w = weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BIAS + 1)
        table[at] = w
        for batch in batches:
            sums = np.full(batch.num_rows, table[BIAS] if len(at) else -np.inf)
            for words in words_of(batch.column("text"), NOT_ALNUM, lower=True):
                text, bucket = _features(words)
                known = table[bucket] != 0
                text, bucket = _present(text[known], bucket[known])
                n = len(words.cuts) - 1
                sums[words.first : words.first + n] += np.bincount(text, table[bucket], n)
            scores = 1 / (1 + np.exp(-np.clip(sums, -700, 700)))
            if not len(at):
                scores[:] = 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, out])

    if out in docs.columns:
        raise ValueError(f"the table already has a column {out}")
    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score_rows(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
