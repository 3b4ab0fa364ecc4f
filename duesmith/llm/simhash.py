"""SimHash near-dedup with bit-sliced comparison.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it set.
Two fingerprints that differ in at most ``radius`` of 64 bits agree in full on ``blocks - radius``
of any ``blocks`` blocks, so every link lies in a bucket of one of the tables keyed by those
blocks: no link is lost, and few fingerprints meet by chance.  Within a bucket fingerprints are
compared on bit planes, 64 at a time, with carry-save counters (``bitslices``).

Equal fingerprints are reduced to one before any comparison, so a group of copies costs one row.
A bucket reports its links as stars, not pairs; stars of all tables join to components.  A large
bucket is searched breadth first: what is reached is compared no more, so a dense group of near
copies costs about its size.

``similar_groups`` finds texts that share at least ``similarity`` of their different shingles, which
differ in too many bits for 64-bit blocks.  Fingerprints of 512 bits only choose candidates: those
that agree on two smallest shingle hashes in at least one of ``BANDS`` tables and differ in no more
bits than the share leads to and ``MARGIN`` standard deviations.  Every link is checked on the
shingles themselves: first the stars of the candidates, then all candidate pairs whose ends the
checked stars leave apart.  A pair at exactly 0.8 misses all tables once in some 28,000 cases, and
the bits in about as many.

Null and empty texts have fingerprint zero, linked like any other.  A null ``doc_id`` is never the
smallest of a component unless it is alone; repeated rows are returned as often as they occur; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations
from math import acos, comb, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duesmith.llm.bitslices import linked, linked_by_search, near_pairs
from duesmith.llm.common import id_and_text, read_table, ship_code, texts_of, unused_name
from duesmith.llm.components import components
from duesmith.llm.words import mix
from duesmith.sources.workspace import stored

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints that a bucket should hold on average, at most.
BUCKET_ROWS = 8
#: Buckets above this size are searched breadth first.
SEARCH_ROWS = 1024
#: Hashes whose bits are counted together.
_PORTION = 1 << 15
#: 64-bit words of the wide fingerprints, and tables that these are compared in.
WIDE = 8
BANDS = 10
MARGIN = 4.0
_TURNS = np.random.default_rng(5).integers(0, 1 << 63, 2 * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of every run of so many words, repeats included; of the whole text if it has fewer."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(found) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist(), strict=True)]


def _majority_of(hashes: np.ndarray) -> np.uint64:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PORTION):
        bits = np.unpackbits(hashes[at : at + _PORTION].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]


def _majority(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprints: bits that more than half of a list's hashes have."""
    return np.array([_majority_of(np.array(some, np.uint64)) if some else 0 for some in hashes], np.uint64)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits, as a signed number) of every document."""
    ship_code(docs.sparkSession)
    rows = id_and_text(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [
                _majority([shingle_hashes(text, words) for text in texts])
                for _, texts in texts_of(batch.column("text"), 64)
            ]
            both = np.concatenate(marks) if marks else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(both.view(np.int64))], ["doc_id", "fp"]
            )

    return rows.mapInArrow(mark, f"doc_id {id_type}, fp bigint")


def block_masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` blocks, as signed numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def blocks_for(n: int, radius: int) -> int:
    """The fewest blocks whose keys have enough values for ``n`` fingerprints."""
    blocks = radius + 1
    while blocks < 2 * radius and n > BUCKET_ROWS << (64 * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def _compared(rows: DataFrame, radius: int, told: Callable | None = None) -> DataFrame:
    """Stars ``a, b`` of nodes at most ``radius`` bits apart in rows ``table, key, node, f0, f1, ...``.

    ``told`` may be given to tell something else than the stars of whole buckets.
    """
    ship_code(rows.sparkSession)
    # Rows of one bucket meet in one task and are neighbours after the sort.
    told = told or _stars
    dealt = rows.repartition("table", "key").sortWithinPartitions("table", "key", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            if held is not None:
                new = [np.concatenate(pair) for pair in zip(held, new, strict=True)]
            table, key = new[:2]
            whole = 0  # the last bucket may go on in the next batch
            if len(key):
                whole = int(np.argmax((table == table[-1]) & (key == key[-1])))
            held = [x[whole:] for x in new]
            yield from told([x[:whole] for x in new], radius)
        if held is not None:
            yield from told(held, radius)

    return dealt.mapInArrow(compare, "a bigint, b bigint")


def links(distinct: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Stars ``a, b`` that connect the distinct ``fp`` at most ``radius`` bits apart."""
    masks = block_masks(blocks_for(n, radius), radius)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(mask)) for mask in masks])
    return _compared(
        distinct.select(F.posexplode(keys).alias("table", "key"), F.col("fp").alias("node"), F.col("fp").alias("f0")),
        radius,
    )


def _stars(columns: list[np.ndarray], radius: int) -> Iterator[pa.RecordBatch]:
    table, key, node, *words = columns
    if not len(node):
        return
    fps = np.stack([word.view(np.uint64) for word in words], axis=1)
    change = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
    begins, ends = np.append(0, change), np.append(change, len(node))
    sizes = ends - begins
    a, b = [], []

    def tell(nodes: np.ndarray, root: np.ndarray) -> None:
        moved = root != np.arange(len(nodes))
        a.append(nodes[moved])
        b.append(nodes[root[moved]])

    middle = (sizes > 1) & (sizes <= SEARCH_ROWS)
    rows = np.repeat(middle, sizes)
    if rows.any():
        tell(node[rows], linked(fps[rows], np.repeat(np.cumsum(sizes[middle]), sizes[middle]), radius))
    for begin, end in zip(begins[sizes > SEARCH_ROWS], ends[sizes > SEARCH_ROWS], strict=True):
        tell(node[begin:end], linked_by_search(fps[begin:end], radius))
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest ``doc_id`` that links of fingerprints lead to."""
    marked = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "distinct-fingerprints")
    roots = components(links(distinct, distinct.count(), radius))
    members = roots.withColumnRenamed("node", "fp").join(distinct, "fp")
    least = members.groupBy("root").agg(F.min("smallest").alias("component_id"))
    moved = members.join(least, "root").select("fp", "component_id")
    named = distinct.join(moved, "fp", "left").select(
        "fp", F.coalesce("component_id", "smallest").alias("component_id")
    )
    # Stored, so that the join is free to split a fingerprint that very many documents share.
    return marked.join(stored(named, "named-fingerprints"), "fp").select("doc_id", "fp", "component_id")


@lru_cache
def _few_differ(similarity: float) -> float:
    """The largest share of differing bits that so similar texts of few shingles lead to.

    Of ``both`` common shingles and ``x`` and ``y`` others, every number that has a given bit is tried.
    """
    worst = 0.0
    for both in range(1, 25):
        others = int(both * (1 - similarity) / similarity + 1e-9)
        for x in range(others + 1):
            y, differ = others - x, 0
            for k in range(both + 1):
                for i in range(x + 1):
                    for j in range(y + 1):
                        if (2 * (k + i) > both + x) != (2 * (k + j) > both + y):
                            differ += comb(both, k) * comb(x, i) * comb(y, j)
            worst = max(worst, differ / (1 << (both + others)))
    return worst


def similar_radius(similarity: float, bits: int) -> int:
    """Differing bits to allow: those expected at that share of common shingles, and a margin."""
    share = max(acos(2 * similarity / (1 + similarity)) / pi, _few_differ(similarity))
    return int(bits * share + MARGIN * sqrt(bits * share * (1 - share)))


def _shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def _sketch(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A wide fingerprint of different hashes, and for each band a key of two smallest hashes."""
    if not len(h):
        return np.zeros(WIDE, np.uint64), np.zeros(BANDS, np.uint64)
    marks = [
        _majority_of(mix(h + np.uint64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1))) for i in range(WIDE)
    ]
    least = np.full(2 * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(h), _PORTION):
        np.minimum(least, (h[begin : begin + _PORTION, None] * _TURNS).min(axis=0), out=least)
    return np.array(marks, np.uint64), mix(least[::2] * np.uint64(0xD6E8FEB86659FD93) + least[1::2])


def _keyed(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).select(F.xxhash64("doc_id", "text").alias("row_key"), "text")


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``row_key, same, f0, f1, ..., keys`` of every document; ``same`` is a hash of its set of shingles."""
    ship_code(docs.sparkSession)
    names = [f"f{i}" for i in range(WIDE)]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (_shingle_set(text, words) for _, texts in texts_of(batch.column("text"), 64) for text in texts)
            found = [(xxhash.xxh64_intdigest(h.tobytes(), SEED), *_sketch(h)) for h in sets]
            same = np.array([s for s, _, _ in found], np.uint64).view(np.int64)
            marks = np.array([f for _, f, _ in found], np.uint64).reshape(-1, WIDE).view(np.int64)
            keys = [k.view(np.int64) for _, _, k in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key"),
                    pa.array(same),
                    *map(pa.array, marks.T.copy()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["row_key", "same", *names, "keys"],
            )

    marks = ", ".join(f"{f} bigint" for f in names)
    return _keyed(docs).mapInArrow(mark, f"row_key bigint, same bigint, {marks}, keys array<bigint>")


def _shingle_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` (different hashes) of the texts whose ``row_key`` is a ``node``."""
    ship_code(docs.sparkSession)
    wanted = _keyed(docs).join(nodes, F.col("row_key") == F.col("node"), "left_semi")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [
                _shingle_set(text, words).view(np.int64)
                for _, texts in texts_of(batch.column("text"), 64)
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"]
            )

    # Rows with one key are repeats of one row.
    return wanted.dropDuplicates(["row_key"]).mapInArrow(cut, "node bigint, shingles array<bigint>")


def _checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` ``a, b`` whose sets of shingles have at least that share in common."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - common
    return pairs.join(one, "a").join(other, "b").where(common >= similarity * either - 1e-9).select("a", "b")


def _apart(columns: list[np.ndarray], radius: int) -> Iterator[pa.RecordBatch]:
    """All pairs of a bucket at most ``radius`` bits apart whose ``root``, the last column, differs."""
    table, key, node, *words, root = columns
    if not len(node):
        return
    fps = np.stack([word.view(np.uint64) for word in words], axis=1)
    change = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
    begins, ends = np.append(0, change), np.append(change, len(node))
    # Buckets of one group have nothing left to compare.
    open_ = np.minimum.reduceat(root, begins) != np.maximum.reduceat(root, begins)
    rows = np.repeat(open_, ends - begins)
    if not rows.any():
        return
    node, root, sizes = node[rows], root[rows], (ends - begins)[open_]
    for a, b in near_pairs(fps[rows], np.repeat(np.cumsum(sizes), sizes), radius):
        differ = root[a] != root[b]
        yield pa.RecordBatch.from_arrays([pa.array(node[a[differ]]), pa.array(node[b[differ]])], ["a", "b"])


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``row_key`` (hash of id and text) and ``root`` of its group, for every document."""
    marked = stored(sketches(docs, words), "sketches")
    names = [f"f{i}" for i in range(WIDE)]
    distinct = marked.groupBy("same", *names).agg(F.min("row_key").alias("node"), F.min("keys").alias("keys"))
    distinct = stored(distinct, "distinct-sketches")
    radius = similar_radius(similarity, 64 * WIDE)

    def tables(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(F.posexplode("keys").alias("table", "key"), "node", *names, *more)

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    stars = stored(ordered(_compared(tables(distinct), radius)), "candidate-stars")
    nodes = stored(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidates")
    sets = stored(_shingle_sets(docs, nodes, words), "shingle-sets")
    checked = stored(_checked(stars, sets, similarity), "checked-stars")
    roots = components(checked)
    grouped = distinct.join(nodes, "node", "left_semi").join(roots, "node", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "node"))
    pairs = stored(ordered(_compared(tables(grouped, "root"), radius, _apart)), "candidate-pairs")
    roots = components(checked.unionAll(_checked(pairs, sets, similarity)))
    named = distinct.join(roots, "node", "left").select("same", F.coalesce("root", "node").alias("root"))
    return marked.join(stored(named, "named-sketches"), "same").select("row_key", "root")


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when similar texts are reduced to one."""
    return _one_of(docs, similar_groups(docs, words, similarity))


def near_roots(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``row_key`` (hash of id and text) and ``root`` (a fingerprint) of its component, for every document."""
    marked = fingerprints(_keyed(docs).select(F.col("row_key").alias("doc_id"), "text"), words)
    marked = stored(marked.select(F.col("doc_id").alias("row_key"), "fp"), "fingerprints")
    distinct = stored(marked.select("fp").distinct(), "distinct-fingerprints")
    roots = components(links(distinct, distinct.count(), radius)).withColumnRenamed("node", "fp")
    named = distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return marked.join(stored(named, "named-fingerprints"), "fp").select("row_key", "root")


def one_of_near(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when linked fingerprints are reduced to one."""
    return _one_of(docs, near_roots(docs, words, radius))


def _one_of(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """Of each group of ``row_key, root`` the row with the smallest ``doc_id`` (a null one only if all
    are), of repeated rows one."""
    key, kept, again = (unused_name(name, docs) for name in ("row_key", "kept_key", "again"))
    keyed = docs.withColumn(key, F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit(""))))
    ids = keyed.select(F.col(key).alias("id_key"), "doc_id").distinct()
    groups = grouped.distinct()
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key")))
    stay = (
        groups.join(ids, groups["row_key"] == ids["id_key"])
        .groupBy("root")
        .agg(least.alias("least"))
        .select(F.col("least.row_key").alias(kept))
    )
    # Rows with one key are repeats of one row.
    joined = keyed.join(stay, F.col(key) == F.col(kept))
    joined = joined.withColumn(again, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    return joined.where(F.col(again) == 1).select(*docs.columns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = near_groups(read_table(spark, sf_dir, "documents"))
    return grouped.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
