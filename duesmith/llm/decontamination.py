"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words are counted over all documents.
2. Benchmark passages and all passages of all documents become TF-IDF vectors over the benchmark's
   words; an SVD of that matrix (a power step from the benchmark's own directions and random ones,
   orthonormalisation, each a job over the rows) gives a latent space of ``RANK`` dimensions.
3. Every passage of every document (``PASSAGE`` words, half overlapping) is projected into the
   space and compared with the directions of all benchmark passages; for those with the least
   ``LATENT`` product the cosine of the TF-IDF vectors themselves decides who is a candidate.  Only
   words of the benchmark reach the space, so a passage that has too little weight in them is passed
   over; this loses nothing.
   Verbatim copies do not depend on the words around them, nor on how many documents have them: a
   run of ``RUN`` words (all words of a shorter item) that stands in the benchmark makes its place a
   candidate too, found by the run's hash.  So no copy with such a run left is lost.
4. Candidates are checked on the words themselves: some stretch of the document, half as long
   again as the benchmark passage, must have a longest common subsequence with it of ``SURE`` of its
   words, or of ``LIKELY`` if the answer is near too.
   Without an ``answer`` column the last third of a passage stands for its answer.

The benchmark is taken in blocks of about ``BLOCK_ITEMS`` passages, which bounds what travels with
the tasks; documents are scanned once for each block and never shuffled.  Within a block at most
``SPACE_ITEMS`` passages share a latent space, so that its ``RANK`` directions tell them apart.

Null and empty texts match nothing, on either side.  Items of fewer than ``LEAST_WORDS`` words must
be found whole.  Null and repeated ids are reported as they are; an empty table gives no rows; other
columns are ignored, or carried along by ``clean_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from duesmith.llm.common import id_and_text, read_table, ship_code
from duesmith.llm.words import NOT_ALNUM, Words, mix, words_of
from duesmith.sources.workspace import stored

BITS = 18
RANK = 96
#: Benchmark passages that share a space, and how much more than a document's passage each weighs.
SPACE_ITEMS, ITEM_WEIGHT = 256, 3.0
#: What all passages of all documents weigh together in a space, at most; each document the same.
DOCUMENTS_WEIGHT = 2048
#: Benchmark passages that travel together; an item has one passage or more.
BLOCK_ITEMS = 1024
#: Words of a document passage, and of the halves by which passages move on.
PASSAGE = 32
STEP = PASSAGE // 2
#: Words of a benchmark passage at most; longer items are cut evenly.
ITEM_WORDS = 64
#: Tasks that add up the parts of a matrix, and so parts that the driver adds.
FIT_TASKS = 4
#: Parts that one task adds up, while there are more.
FIT_JOIN = 16
#: Documents whose passages one task multiplies, and words that it does together.
FIT_DOCUMENTS = 16_384
_PORTION = 1 << 15
LEAST_WORDS = 8
LATENT, LEAST_COSINE = 0.3, 0.3
#: Words that follow each other as in the benchmark and so make a place a candidate.
RUN = 5
SURE, LIKELY, ANSWER = 0.7, 0.5, 0.8


def _buckets(words: Words) -> np.ndarray:
    return (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each hash bucket occurs, and the number of documents."""
    ship_code(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for words in words_of(batch.column("text"), NOT_ALNUM, lower=True):
                both = np.unique((words.text_of << BITS) | _buckets(words))
                seen += np.bincount(both & ((1 << BITS) - 1), minlength=1 << BITS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))], ["bucket", "n"]
        )

    counted = (
        docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    ).toPandas()  # one row for each bucket and one for the total
    found = np.zeros(1 << BITS, np.int64)
    known = counted["bucket"] >= 0
    found[counted["bucket"][known]] = counted["n"][known]
    return found, int(counted["n"][~known].sum())


@dataclass(frozen=True)
class Query:
    """One benchmark passage: its item, its word hashes, and those of the answer."""

    item_id: object
    words: tuple[int, ...]
    answer: tuple[int, ...]


def _cut(words: list[int], most: int) -> list[list[int]]:
    parts = max(1, -(-len(words) // most))
    edges = [len(words) * i // parts for i in range(parts + 1)]
    return [words[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _hashed(texts: list[str]) -> list[list[int]]:
    return [
        words.hashes[words.cuts[i] : words.cuts[i + 1]].tolist()
        for words in words_of(pa.array(texts, pa.large_string()), NOT_ALNUM, lower=True)
        for i in range(len(words.cuts) - 1)
    ]


def _signed(hashes: list[int]) -> list[int]:
    return [h - (1 << 64) if h >> 63 else h for h in hashes]


def _unsigned(hashes: list[int]) -> tuple[int, ...]:
    return tuple(h & 0xFFFFFFFFFFFFFFFF for h in hashes)


def _passages(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, answer`` (hashes, as signed numbers) of the different passages of all items."""
    ship_code(benchmark.sparkSession)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text", answer.alias("answer"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _hashed(batch.column("text").to_pylist())
            answers = _hashed([answer or "" for answer in batch.column("answer").to_pylist()])
            found = [
                (row, _signed(part), _signed(answer or part[-max(1, len(part) // 3) :]))
                for row, (words, answer) in enumerate(zip(texts, answers, strict=True))
                for part in _cut(words, ITEM_WORDS)
                if part
            ]
            at, *lists = zip(*found, strict=True) if found else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").take(pa.array(at, pa.int64())),
                    *[pa.array(some, pa.list_(pa.int64())) for some in lists],
                ],
                ["item_id", "words", "answer"],
            )

    item_type = benchmark.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(cut, f"item_id {item_type}, words array<bigint>, answer array<bigint>").distinct()


@dataclass(frozen=True)
class LatentSpace:
    """Row of each hash bucket in ``basis`` (-1: not in the benchmark), and the queries' directions in the
    space; ``vectors`` holds the queries themselves."""

    idf: np.ndarray
    row: np.ndarray
    basis: np.ndarray
    queries: np.ndarray
    vectors: np.ndarray


@dataclass(frozen=True)
class Runs:
    """Runs of one length that stand in the benchmark: their hashes in order, and whose they are.

    ``owners`` has the queries of hash i from ``begins[i]`` on.
    """

    length: int
    hashes: np.ndarray
    begins: np.ndarray
    owners: np.ndarray

    @staticmethod
    def hashed(hashes: np.ndarray, length: int) -> np.ndarray:
        """The hash of the run that begins at each word; the last few have none."""
        count = max(len(hashes) - length + 1, 0)
        total = np.zeros(count, np.uint64)
        for step in range(length):
            total = mix(total + hashes[step : step + count])
        return total

    @classmethod
    def of(cls, queries: list[Query]) -> list[Runs]:
        """An index for each run length: ``RUN``, and the lengths of shorter queries."""
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, query in enumerate(queries):
            length = min(RUN, len(query.words))
            by_length.setdefault(length, []).append((np.unique(cls.hashed(np.array(query.words, np.uint64), length)), i))
        found = []
        for length, parts in sorted(by_length.items()):
            every = np.concatenate([hashes for hashes, _ in parts])
            owners = np.repeat([i for _, i in parts], [len(hashes) for hashes, _ in parts])
            order = np.argsort(every, kind="stable")
            hashes, begins = np.unique(every[order], return_index=True)
            found.append(cls(length, hashes, np.append(begins, len(every)), owners[order]))
        return found

    def places(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """Text, word and query of each run found."""
        runs = self.hashed(words.hashes, self.length)
        if not len(runs):
            return
        at = np.minimum(np.searchsorted(self.hashes, runs), len(self.hashes) - 1)
        text_of = words.text_of
        inside = text_of[: len(runs)] == text_of[self.length - 1 :]
        for word in np.flatnonzero((self.hashes[at] == runs) & inside).tolist():
            for query in self.owners[self.begins[at[word]] : self.begins[at[word] + 1]].tolist():
                yield int(text_of[word]), word, query


def _squares(passage: np.ndarray, bucket: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Squared lengths of the TF-IDF vectors of ``n`` passages, given the passage and bucket of each word."""
    keys, tf = np.unique((passage << BITS) | bucket, return_counts=True)
    return np.bincount(keys >> BITS, (tf * idf[keys & ((1 << BITS) - 1)]) ** 2, n)


def all_passages(docs: DataFrame, n: int, idf: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """Every passage of every document, as it takes part in the fit: a row for each document that has words
    of the benchmark, with the buckets ``at`` of these words, how many of them each passage has
    (``sizes``) and what passages are multiplied by (``scales``).

    A document's passages lie next to each other.  Documents weigh the same, however many passages
    they have, and together as much as ``DOCUMENTS_WEIGHT`` passages of weight 1.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast((idf, wanted))
    share = min(1.0, DOCUMENTS_WEIGHT / max(n, 1))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, wanted = shared.value
        for batch in batches:
            found: list[tuple[bytes, bytes, bytes]] = []
            for words in words_of(batch.column("text"), NOT_ALNUM, lower=True):
                bucket, text = _buckets(words), words.text_of
                tiles = -(-np.diff(words.cuts) // PASSAGE)
                edges = np.append(0, np.cumsum(tiles))
                passage = edges[text] + (np.arange(len(bucket)) - words.cuts[text]) // PASSAGE
                squares = _squares(passage, bucket, idf, edges[-1])
                scales = np.sqrt(share / np.repeat(tiles, tiles) / np.maximum(squares, 1e-24)).astype(np.float32)
                known = wanted[bucket]
                sizes = np.bincount(passage[known], minlength=edges[-1]).astype(np.int32)
                at = bucket[known].astype(np.int32)
                begins = np.append(0, np.cumsum(sizes))[edges]
                for i in np.flatnonzero(np.diff(begins)).tolist():
                    low, high = edges[i], edges[i + 1]
                    found.append((
                        at[begins[i] : begins[i + 1]].tobytes(), sizes[low:high].tobytes(), scales[low:high].tobytes()
                    ))
            columns = [pa.array(x, pa.binary()) for x in (zip(*found, strict=True) if found else [()] * 3)]
            yield pa.RecordBatch.from_arrays(columns, ["at", "sizes", "scales"])

    return docs.select("text").mapInArrow(cut, "at binary, sizes binary, scales binary")


def _projected(
    at: np.ndarray, sizes: np.ndarray, scales: np.ndarray, table: np.ndarray
) -> Iterator[tuple[np.ndarray, ...]]:
    """Passages, as rows of a matrix, times ``table``: some at a time, so that what they make stays in cache,
    each time the words' rows, the passage of each word, the products
    and the passages' scales."""
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        first = ends[begin] - sizes[begin]
        end = max(begin + 1, int(np.searchsorted(ends, first + _PORTION, "right")))
        some = sizes[begin:end]
        if ends[end - 1] > first:
            rows, scale, some = at[first : ends[end - 1]], scales[begin:end][some > 0], some[some > 0]
            y = np.add.reduceat(table[rows], np.cumsum(some) - some, axis=0)
            yield rows, np.repeat(np.arange(len(some)), some), y * scale[:, None], scale
        begin = end


def _turned_back(rows: np.ndarray, owner: np.ndarray, y: np.ndarray, scale: np.ndarray, total: np.ndarray) -> None:
    """Adds to ``total`` the transpose of that matrix times ``y``."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    total[ordered[heads]] += np.add.reduceat((y * scale[:, None])[owner[order]], heads, axis=0)


def fit(queries: list[Query], passages: DataFrame, n: int, idf: np.ndarray, rank: int = RANK) -> LatentSpace:
    """SVD of the TF-IDF matrix of queries and ``all_passages`` of ``n`` documents; tasks work on
    their share of the rows."""
    vocabulary = np.unique([h >> (64 - BITS) for query in queries for h in query.words]).astype(np.int64)
    wide = min(rank + 16, len(vocabulary))
    row = np.full(1 << BITS, -1, np.int32)
    row[vocabulary] = np.arange(len(vocabulary))
    weight = idf[vocabulary][:, None]
    vectors = np.zeros((len(queries), len(vocabulary)), np.float32)
    for i, query in enumerate(queries):
        at, tf = np.unique(row[[h >> (64 - BITS) for h in query.words]], return_counts=True)
        x = tf * weight[at, 0]
        vectors[i, at] = x / max(np.linalg.norm(x), 1e-12)
    spark = passages.sparkSession
    ship_code(spark)
    rows_of = spark.sparkContext.broadcast(row)
    tasks = max(1, -(-n // FIT_DOCUMENTS))
    dealt = passages.coalesce(tasks)

    def over_passages(directions: np.ndarray, back: bool) -> np.ndarray:
        """The passages' matrix and its transpose applied to some directions (``back``), or the products
        that the directions then have with each other: one job."""
        table = spark.sparkContext.broadcast((weight * directions).astype(np.float32))
        shape = directions.shape if back else directions.shape[1:] * 2

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                at, sizes, scales = (
                    np.frombuffer(b"".join(batch.column(name).to_pylist()), kind)
                    for name, kind in (("at", np.int32), ("sizes", np.int32), ("scales", np.float32))
                )
                at = rows_of.value[at]
                known = at >= 0
                if not known.all():  # words of other passages of the benchmark
                    sizes = np.diff(np.append(0, np.cumsum(known))[np.append(0, np.cumsum(sizes))])
                for rows, owner, y, scale in _projected(at[known], sizes, scales, table.value):
                    if back:
                        _turned_back(rows, owner, y, scale, total)
                    else:
                        total += y.T @ y
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for part in batch.column("total"):
                    total += np.frombuffer(part.as_py()).reshape(shape)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

        parts, many = dealt.mapInArrow(multiply, "total binary"), tasks
        while many > FIT_TASKS:
            many = max(FIT_TASKS, -(-many // FIT_JOIN))
            parts = parts.repartition(many).mapInArrow(add, "total binary")
        total = np.zeros(shape)
        for part in parts.toLocalIterator():  # one for each of FIT_TASKS
            total += np.frombuffer(part["total"]).reshape(shape)
        table.destroy()
        return weight * total if back else total

    # The directions of the benchmark itself, and random ones, go through a power step over everything.
    _, _, own = np.linalg.svd(vectors.astype(float), full_matrices=False)
    own = own[:rank]
    more = np.random.default_rng(11).standard_normal((wide - len(own), len(vocabulary)))
    directions, _ = np.linalg.qr(np.concatenate([own, more]).T)
    back = ITEM_WEIGHT**2 * (vectors.T @ (vectors @ directions)) + over_passages(directions, back=True)
    directions, _ = np.linalg.qr(back)
    # Among what the power step has found, the directions of most weight.
    seen = vectors @ directions
    _, turned = np.linalg.eigh(ITEM_WEIGHT**2 * (seen.T @ seen) + over_passages(directions, back=False))
    basis = directions @ turned[:, ::-1][:, :rank]
    inside = vectors @ basis
    inside /= np.maximum(np.linalg.norm(inside, axis=1, keepdims=True), 1e-12)
    return LatentSpace(idf.astype(np.float32), row, basis.astype(np.float32), inside.astype(np.float32), vectors)


def common_subsequence(a: list[int], b: tuple[int, ...]) -> int:
    """Length of the longest common subsequence, a bit for each element of ``b``."""
    places: dict[int, int] = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        if x in places:
            match = row & places[x]
            row = ((row + match) | (row - match)) & full
    return len(b) - row.bit_count()


def closest_share(region: list[int], query: tuple[int, ...]) -> float:
    """The largest share of ``query`` that is a subsequence of some stretch half as long again.

    Words strewn over a longer stretch are no copy.  A short query counts only where it stands whole.
    """
    n = len(query)
    if n < LEAST_WORDS:
        return float(any(tuple(region[i : i + n]) == query for i in range(len(region) - n + 1)))
    shared = set(query)
    kept = [x for x in region if x in shared]  # no other word can be in a common subsequence
    if len(kept) < LIKELY * n or common_subsequence(kept, query) < LIKELY * n:
        return 0.0
    size, step = n + n // 2, max(1, n // 4)
    starts = range(0, max(1, len(region) - size + step), step)
    return max(common_subsequence(region[i : i + size], query) for i in starts) / n


def _norms(passage: np.ndarray, owner: np.ndarray, bucket: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Lengths of the TF-IDF vectors of passages, given the buckets of all their words; a passage that
    stands several times is computed once."""
    _, first, same = np.unique(passage, return_index=True, return_inverse=True)
    once = np.zeros(len(passage), bool)
    once[first] = True
    mine = once[owner]
    keys, tf = np.unique((same[owner[mine]] << BITS) | bucket[mine], return_counts=True)
    squares = (tf * idf[keys & ((1 << BITS) - 1)].astype(np.float64)) ** 2
    return np.sqrt(np.maximum(np.bincount(keys >> BITS, squares, len(first)), 1e-12))[same]


def _candidates(words: Words, space: LatentSpace) -> Iterator[tuple[int, int, int, float]]:
    """Text, first word of the passage (in the portion), query and cosine."""
    if not len(words.hashes) or not len(space.queries):
        return
    bucket = _buckets(words)
    idf, row = space.idf[bucket], space.row[bucket]
    sizes = np.diff(words.cuts)
    blocks = -(-sizes // STEP)
    first_block = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(text)) - first_block[text]
    begin = words.cuts[text] + STEP * nth
    square = idf.astype(np.float64) ** 2
    energy = np.add.reduceat(square, begin)
    known = np.add.reduceat(np.where(row >= 0, square, 0), begin)
    # A passage is a block and the next one of the same text; a text of one block is a passage too.
    two = np.append(text[1:] == text[:-1], False)
    alone = blocks[text] == 1
    at = np.flatnonzero(two | alone)
    nxt = np.where(two[at], at + 1, at)
    twice = np.where(two[at], 1.0, 0.0)
    p_energy = energy[at] + twice * energy[nxt]
    p_known = known[at] + twice * known[nxt]
    keep = p_known >= LEAST_COSINE**2 * p_energy
    at, nxt, twice, p_energy = at[keep], nxt[keep], twice[keep], p_energy[keep]
    if not len(at):
        return
    needed = np.unique(np.append(at, nxt))
    ends = np.append(begin[1:], len(bucket))[needed]
    size = ends - begin[needed]
    owner = np.repeat(np.arange(len(needed)), size)
    word = begin[needed][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    inside = row[word] >= 0
    owner, word = owner[inside], word[inside]
    sums = np.zeros((len(needed), space.basis.shape[1]), np.float32)
    if len(owner):
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sums[owner[heads]] = np.add.reduceat(space.basis[row[word]] * idf[word][:, None], heads, axis=0)
    place = np.searchsorted(needed, at), np.searchsorted(needed, nxt)
    vectors = sums[place[0]] + twice[:, None].astype(np.float32) * sums[place[1]]
    length = np.sqrt(np.maximum(p_energy, 1e-12))
    p, q = np.nonzero((vectors @ space.queries.T) >= LATENT * length[:, None].astype(np.float32))
    if not len(p):
        return
    # Of these the words themselves are looked up in the query.
    first = begin[at[p]]
    size = np.append(begin[1:], len(bucket))[nxt[p]] - first
    owner = np.repeat(np.arange(len(p)), size)
    word = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    weight = np.where(row[word] >= 0, space.vectors[q[owner], row[word]] * idf[word], 0)
    cosines = np.bincount(owner, weight, len(p)) / _norms(p, owner, bucket[word], space.idf)
    for i in np.flatnonzero(cosines >= LEAST_COSINE).tolist():
        yield int(text[at[p[i]]]), int(first[i]), int(q[i]), float(min(cosines[i], 1.0))


def _places(words: Words, space: LatentSpace, runs: list[Runs]) -> Iterator[tuple[int, int, int, float]]:
    """Text, word, query and cosine (0: found by a run) of the places to look at, near ones once."""
    seen: set[tuple[int, int, int]] = set()
    for text, begin, q, cosine in _candidates(words, space):
        seen.add((text, q, begin // PASSAGE))
        yield text, begin, q, cosine
    for index in runs:
        for text, word, q in index.places(words):
            if (text, q, word // PASSAGE) not in seen:
                seen.add((text, q, word // PASSAGE))
                yield text, word, q, 0.0


def _leaks(
    column: pa.Array, spaces: list[tuple[list[Query], LatentSpace, list[Runs]]]
) -> Iterator[tuple[int, object, float, float, float, int]]:
    """Row, item, cosine, share of the query and of its answer, place of the passage in words."""
    for words in words_of(column, NOT_ALNUM, lower=True):
        best: dict[tuple[int, object], tuple] = {}
        candidates = (
            (text, begin, queries[q], cosine)
            for queries, space, runs in spaces
            for text, begin, q, cosine in _places(words, space, runs)
        )
        for text, begin, query, cosine in candidates:
            around = len(query.words) + STEP
            low = max(int(words.cuts[text]), begin - around)
            high = min(int(words.cuts[text + 1]), begin + PASSAGE + around)
            region = words.hashes[low:high].tolist()
            share = closest_share(region, query.words)
            if share < LIKELY:
                continue
            answer = common_subsequence(region, query.answer) / len(query.answer)
            if share >= SURE or answer >= ANSWER:
                found = (share, cosine, answer, begin - int(words.cuts[text]))
                best[text, query.item_id] = max(found, best.get((text, query.item_id), found))
        for (text, item_id), (share, cosine, answer, place) in sorted(best.items(), key=lambda x: x[0][0]):
            yield words.first + text, item_id, cosine, share, answer, place


def _benchmark_buckets(passages: DataFrame) -> np.ndarray:
    """The hash buckets that the benchmark's words fall into."""
    every = passages.select(F.explode("words").alias("word"))
    found = every.select(F.shiftrightunsigned("word", 64 - BITS).alias("bucket")).distinct().toPandas()  # at most all
    return found["bucket"].to_numpy(np.int64)


def _blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[object]:
    """Of each block of the benchmark its queries and their latent spaces, as a broadcast variable."""
    spark = docs.sparkSession
    passages = stored(_passages(benchmark), "benchmark-passages")
    parts = -(-passages.count() // BLOCK_ITEMS)
    if not parts:
        return
    df, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1
    wanted = np.zeros(1 << BITS, bool)
    wanted[_benchmark_buckets(passages)] = True
    every = stored(all_passages(docs, n, idf, wanted), "document-passages")
    block = F.pmod(F.xxhash64("item_id", "words", "answer"), F.lit(parts))
    for part in range(parts):
        queries = [
            Query(row["item_id"], _unsigned(row["words"]), _unsigned(row["answer"]))
            for row in passages.where(block == part).collect()  # about BLOCK_ITEMS rows
        ]
        if queries:
            groups = [queries[at : at + SPACE_ITEMS] for at in range(0, len(queries), SPACE_ITEMS)]
            yield spark.sparkContext.broadcast([(group, fit(group, every, n, idf), Runs.of(group)) for group in groups])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, lcs_share, answer_share, at_word`` of every leak found."""
    spark = docs.sparkSession
    rows = id_and_text(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    item_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"doc_id {id_type}, item_id {item_type}, cosine double, lcs_share double, answer_share double, at_word bigint"
    found = spark.createDataFrame([], schema)
    for shared in _blocks(docs, benchmark):

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            spaces = shared.value
            for batch in batches:
                rows = list(_leaks(batch.column("text"), spaces))
                at, item, *rest = zip(*rows, strict=True) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(at, pa.int64())),
                        pa.array(item, item_arrow),
                        *[pa.array(x, pa.float64()) for x in rest[:3]],
                        pa.array(rest[3], pa.int64()),
                    ],
                    ["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "at_word"],
                )

        found = found.unionAll(rows.mapInArrow(search, schema))
    # An item's passages may lie in one document in several portions.
    best = F.max(F.struct("lcs_share", "cosine", "answer_share", "at_word"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.cosine", "b.lcs_share", "b.answer_share", "b.at_word"
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark passage is found."""
    clean = docs
    for shared in _blocks(docs, benchmark):

        def drop(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            spaces = shared.value
            for batch in batches:
                mask = np.ones(batch.num_rows, bool)
                mask[[row for row, *_ in _leaks(batch.column("text"), spaces)]] = False
                yield batch.filter(pa.array(mask))

        clean = clean.mapInArrow(drop, docs.schema)
    return clean


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
