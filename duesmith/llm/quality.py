"""Quality scores by histogram gradient-boosted trees over document statistics.

One scan of whole texts turns each document into a fixed number of statistics: sizes, shares of kinds
of characters, shapes of words and lines, and repetition.  Trees are grown on a bounded sample of
labelled rows (``MOST_LABELS``): statistics become bins at quantiles of that sample, a level of a
tree is grown from histograms of gradients by leaf, statistic and bin, and leaves take Newton steps.
The finished trees are flat arrays of a fixed size (complete trees of ``DEPTH`` levels), which
travel with the scoring function; numpy walks all documents of a batch through a tree level by level.

Null and empty texts have all statistics zero and get the score that the trees give these.  Without
usable labels, or with labels of one kind only, every document gets that share of good labels (0.5
without any).  Labels of repeated ids count once, the best one; labelled ids that several rows share
count by row.  Rows are scored one by one, whatever their ids; an empty table gives no rows, and
``score_rows`` keeps all other columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duesmith.llm.common import read_table, ship_code
from duesmith.llm.words import Words, words_of
from duesmith.sources.workspace import stored

#: Labelled rows that learning takes at most.
MOST_LABELS = 100_000
BINS = 64
TREES, DEPTH, RATE = 120, 4, 0.1
#: Penalty on a leaf's step, and the least gain and weight of a split.
L2, LEAST_GAIN, LEAST_WEIGHT = 1.0, 1e-3, 2.0

UPPER, LOWER, DIGIT, BLANK_, LINE, MARK, OTHER, HIGH = range(8)
#: The kind of each byte; bytes that continue a character count with HIGH ones.
KIND = np.full(256, OTHER)
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[[0x20, 0x09]] = BLANK_
KIND[0x0A:0x0E] = LINE
KIND[[ord(c) for c in ".,;:!?'\"-()"]] = MARK
KIND[128:] = HIGH
KINDS = 8
#: Marks that are counted one by one.
SINGLE = [ord(c) for c in ".,!?#|*$%&/@<>{}=_-"]
LENGTHS = (1, 2, 3, 5, 8, 12, 20, 40)

NAMES = (
    ["bytes", "words", "lines"]
    + [f"kind_{k}" for k in range(KINDS)]
    + [f"byte_{chr(b)}" for b in SINGLE]
    + ["byte_entropy", "run_bytes", "word_length", "word_spread"]
    + [f"words_up_to_{n}" for n in LENGTHS]
    + ["upper_words", "capital_words", "plain_words", "odd_ends", "numbers", "distinct_words", "top_word"]
    + ["distinct_pairs", "top_pair", "distinct_triples", "words_a_line", "distinct_lines", "repeated_line_bytes"]
    + ["open_lines", "words_a_stop", "stop_after_word"]
)


def _distinct(text: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many distinct values it has, and how often its commonest one stands."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    begins = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text[begins], np.diff(np.append(begins, len(text))))
    return np.bincount(text[begins], minlength=n), top


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    out = np.zeros((len(column), len(NAMES)), np.float32)
    for words in words_of(column):
        n = len(words.cuts) - 1
        if len(words.data):
            out[words.first : words.first + n] = _of_portion(words, n)
    return out


def _of_portion(words: Words, n: int) -> np.ndarray:
    data, text_of = words.data, words.text_of
    bounds = words.bounds
    size = np.diff(bounds)
    byte_text = np.repeat(np.arange(n), size)
    kinds = np.bincount(byte_text * KINDS + KIND[data], minlength=n * KINDS).reshape(n, KINDS)
    bytes_ = np.bincount(byte_text * 256 + data, minlength=n * 256).reshape(n, 256)
    shares = _share(bytes_, size[:, None])
    entropy = -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(axis=1)
    again = np.zeros(len(data), bool)
    again[1:] = (data[1:] == data[:-1]) & (byte_text[1:] == byte_text[:-1])

    count = np.diff(words.cuts)
    length = words.ends - words.starts
    per_word = lambda weights: np.bincount(text_of, weights, n)
    mean = _share(per_word(length), count)
    spread = np.sqrt(np.maximum(_share(per_word(length.astype(float) ** 2), count) - mean**2, 0))
    sums = {kind: np.concatenate([[0], np.cumsum(KIND[data] == kind)]) for kind in (UPPER, LOWER, DIGIT, HIGH, MARK)}
    inside = {kind: total[words.ends] - total[words.starts] for kind, total in sums.items()}
    letters = inside[UPPER] + inside[LOWER] + inside[HIGH]
    first, last = KIND[data[words.starts]], KIND[data[words.ends - 1]]
    rest = np.where(length > 1, KIND[data[np.maximum(words.ends - 2, words.starts)]], LOWER)
    odd = ~np.isin(last, (UPPER, LOWER, DIGIT, HIGH, MARK)) | ((last == MARK) & (rest == MARK))
    distinct, top = _distinct(text_of, words.hashes, n)

    def runs(gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        same = text_of[gap:] == text_of[: len(text_of) - gap]
        value = words.hashes[: len(text_of) - gap].copy()
        for step in range(1, gap + 1):
            value = value * np.uint64(0x9E3779B97F4A7C15) + words.hashes[step : len(text_of) - gap + step]
        kept = text_of[gap:][same]
        return (*_distinct(kept, value[same], n), np.bincount(kept, minlength=n))

    pairs, top_pair, n_pairs = runs(1) if len(text_of) > 1 else (np.zeros(n), np.zeros(n), np.zeros(n))
    triples, _, n_triples = runs(2) if len(text_of) > 2 else (np.zeros(n), np.zeros(n), np.zeros(n))

    # Lines by number within the portion; a line's value is the sum of its words' hashes in place.
    breaks = data == 0x0A
    line_of_byte = np.cumsum(breaks) + byte_text
    line = line_of_byte[words.starts] if len(words.starts) else np.zeros(0, np.int64)
    begins = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, np.int64)
    place = np.arange(len(line)) - np.repeat(begins, np.diff(np.append(begins, len(line))))
    value = words.hashes * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    line_text = text_of[begins]
    line_value = np.add.reduceat(value, begins) if len(begins) else np.zeros(0, np.uint64)
    lines = np.bincount(line_text, minlength=n)
    distinct_lines, _ = _distinct(line_text, line_value, n)
    order = np.lexsort((line_value, line_text))
    repeat = np.zeros(len(order), bool)
    repeat[1:] = (line_value[order][1:] == line_value[order][:-1]) & (line_text[order][1:] == line_text[order][:-1])
    line_bytes = np.add.reduceat(length, begins) if len(begins) else np.zeros(0, np.int64)
    repeated = np.bincount(line_text[order][repeat], line_bytes[order][repeat], n)
    ends = np.append(begins[1:], len(line)) - 1 if len(begins) else begins
    open_lines = np.bincount(line_text, ~np.isin(data[words.ends[ends] - 1], [ord(c) for c in ".!?:;\""]), n)

    stops = np.isin(data[words.ends - 1], [ord("."), ord("!"), ord("?")]) if len(words.ends) else np.zeros(0, bool)
    n_stops = per_word(stops)
    columns = [
        np.log1p(size),
        np.log1p(count),
        np.log1p(lines),
        *_share(kinds, size[:, None]).T,
        *shares[:, SINGLE].T,
        entropy,
        _share(np.bincount(byte_text, again, n), size),
        mean,
        spread,
        *[_share(per_word(length <= most), count) for most in LENGTHS],
        _share(per_word((inside[UPPER] > 1) & (inside[LOWER] == 0)), count),
        _share(per_word((first == UPPER) & (inside[LOWER] > 0)), count),
        _share(per_word(letters + inside[MARK] == length), count),
        _share(per_word(odd), count),
        _share(per_word(inside[DIGIT] == length), count),
        _share(distinct, count),
        _share(top, count),
        _share(pairs, n_pairs),
        _share(top_pair, n_pairs),
        _share(triples, n_triples),
        np.log1p(_share(count, lines)),
        _share(distinct_lines, lines),
        _share(repeated, size),
        _share(open_lines, lines),
        np.log1p(_share(count, n_stops)),
        _share(n_stops, count),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass(frozen=True)
class Trees:
    """Complete trees as flat arrays: for node i of a tree the children are 2i + 1 and 2i + 2.

    ``feature`` and ``edge`` have a row for each tree and a column for each inner node (values up to the
    edge go left), ``leaf`` a column for each leaf.  Nodes that were not split send everything left.
    """

    base: float
    feature: np.ndarray
    edge: np.ndarray
    leaf: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        margin = np.full(len(stats), self.base)
        rows = np.arange(len(stats))
        for feature, edge, leaf in zip(self.feature, self.edge, self.leaf):
            node = np.zeros(len(stats), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (stats[rows, feature[node]] > edge[node])
            margin += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def grow(stats: np.ndarray, labels: np.ndarray) -> Trees:
    """Boosted trees on logistic loss, level by level from histograms."""
    n, features = stats.shape
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    good = (labels.sum() + 1) / (n + 2)
    if not n or labels.min() == labels.max():
        base = 35.0 if n and labels.min() else -35.0 if n else 0.0
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0, method="lower").T
    binned = np.stack([np.searchsorted(edges[f], stats[:, f], "left") for f in range(features)], axis=1)
    cell = binned + np.arange(features) * BINS
    base = float(np.log(good / (1 - good)))
    margin = np.full(n, base)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - labels, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, edge = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for level in range(DEPTH):
            first, wide = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (features * BINS) + cell).ravel()
            shape = (wide, features, BINS)
            g, h = (np.bincount(at, np.repeat(v, features), wide * features * BINS).reshape(shape) for v in (gradient, weight))
            gl, hl = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
            gt, ht = g.sum(axis=2)[:, :, None], h.sum(axis=2)[:, :, None]
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
            flat = gain.reshape(wide, -1)
            best = flat.argmax(axis=1)
            for k in np.flatnonzero(flat[np.arange(wide), best] > LEAST_GAIN):
                f, b = divmod(int(best[k]), BINS - 1)
                feature[first + k], edge[first + k] = f, edges[f, b]
            node = 2 * node + 1 + (stats[np.arange(n), feature[node]] > edge[node])
        slot = node - inner
        leaf = -RATE * np.bincount(slot, gradient, leaves) / (np.bincount(slot, weight, leaves) + L2)
        margin += leaf[slot]
        trees.append((feature, edge, leaf))
    return Trees(base, *(np.stack(part) for part in zip(*trees)))


def held_out(id_column: str) -> Column:
    """Rows whose label learning never sees."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Trees:
    """Trees from at most ``most`` labelled rows that are not held out, chosen by a hash of their text and id."""
    ship_code(docs.sparkSession)
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("double").alias("quality"))
    )
    chosen = stored(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "chosen-labels")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(batch.column("text"))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), len(NAMES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("quality"), lists], ["quality", "stats"])

    # At most ``most`` pairs of an id and a label.
    shown = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    # Repeated ids could make more rows than labels; the bound holds for rows.
    described = shown.mapInArrow(describe, "quality double, stats array<float>")
    rows = described.orderBy(F.xxhash64("stats"), "stats", "quality").limit(most).toArrow()
    stats = rows.column("stats").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
    return grow(stats, pc.cast(rows.column("quality"), pa.float64()).to_numpy())


def score_rows(docs: DataFrame, trees: Trees, out: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score in a column named ``out``."""
    if out in docs.columns:
        raise ValueError(f"the table already has a column {out}")
    ship_code(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(trees.score(statistics(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, out])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score_rows(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
