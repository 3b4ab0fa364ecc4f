"""Product codes of vectors by k-means with adaptive distance bounds, in integers throughout.

Vectors become integers ``floor(256 x)`` and are cut into equal parts; each part position has a
codebook of its own.  A round assigns every part to its nearest entry and replaces each entry by the
floored mean of its parts.  Rounds after the first read what the one before persisted for each part:
its entry, the b entries that came next with lower bounds of their distances in ascending order, and
one outer bound for all others.  Entries' moves loosen these bounds; a part whose exact distance to
its own entry lies below all of them keeps it, one that lies above some compares the entries before
the first bound that holds, and only one above the outer bound compares the whole codebook.  How far
parts had to look sets b for what is persisted next, batch by batch, so no pass over the data serves
that alone.  All comparisons that decide are made on whole integers, so the codes are exact.

The data are scanned once for each round and once for the final codes.  What reaches the driver are
codebooks: at most ``PARTS * ENTRIES`` entries.  Sums travel as rows of digits, so that means of
any finite components are exact.

Left out are vectors that are null or empty, that hold null or non-finite components, whose length
no ``PARTS`` equal parts can make up, or whose length is not that of the first kept vector.  Null ids
sort last; repeated ids and rows are rows of their own, in order of their components.  With fewer rows
than entries the codebooks are shorter; an empty table gives no rows.  Sums of squares beyond 64 bits
are null, as are sums over labels that have such a row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith.llm.common import read_table, ship_code
from duesmith.sources.workspace import drop_folder, new_folder, stored, stored_at

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
#: Bounds persisted for each part at first, and at least.
FIRST_BOUNDS, LEAST_BOUNDS = ENTRIES // 4, ENTRIES // 8
#: Vectors that one round of array operations handles.
PORTION = 512
DIGIT = 1 << 48
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """Entries as integers of shape (parts, entries, width); ``small`` if 64 bits hold every sum of squares."""

    entries: np.ndarray
    small: bool

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebooks:
        """From an array of Python integers."""
        small = _fits(entries, entries.shape[0] * entries.shape[2])
        return cls(entries.astype(np.int64) if small else entries, small)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()

    def moves(self, old: Codebooks) -> np.ndarray:
        """Upper bounds of how far each entry has moved."""
        squares = ((self.entries - old.entries) ** 2).sum(axis=2)
        return np.ceil(np.sqrt(squares.astype(np.float64)) * (1 + 1e-9))


def _fits(values: np.ndarray, dims: int) -> bool:
    """Whether sums of ``dims`` squared differences of such values stay within 64 bits."""
    most = isqrt(LARGEST // max(dims, 1)) // 2
    return not values.size or (int(values.max()) <= most and int(values.min()) >= -most)


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(256 x)`` of finite floats: 64-bit integers, or Python ones where these are too small."""
    wide = values.astype(np.float64)
    if not wide.size or np.abs(wide).max() < 2.0**50:
        return np.floor(wide * SCALE).astype(np.int64)
    # Large floats are whole, and their product with SCALE may be no float.
    whole = [floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE for x in wide.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(wide.shape)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis."""
    total = (x[..., 0] - c[..., 0]) ** 2
    for at in range(1, x.shape[-1]):
        total = total + (x[..., at] - c[..., at]) ** 2
    return total


def _single(bounds: np.ndarray) -> np.ndarray:
    """The same in single precision, rounded down."""
    single = bounds.astype(np.float32)
    return np.where(single > bounds, np.nextafter(single, np.float32(-np.inf)), single)


def _below(squares: np.ndarray) -> np.ndarray:
    """Whole numbers not above the distances; whole ones take little room when stored."""
    return _single(np.floor(np.sqrt(squares.astype(np.float64)) * (1 - 1e-9)))


@dataclass
class Bounds:
    """For pairs of a vector and a part: entry, next entries, their lower bounds in order, bound of the rest."""

    code: np.ndarray
    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray


def _ascending(lower: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """Each bound lowered to those that follow it, the outer one last."""
    every = np.concatenate([lower, outer[:, None]], axis=1)
    return np.minimum.accumulate(every[:, ::-1], axis=1)[:, ::-1]


def _search(x: np.ndarray, part: np.ndarray, books: Codebooks, b: int) -> tuple[Bounds, np.ndarray]:
    """Bounds and exact squared distances from a comparison with whole codebooks."""
    squares = _squares(x[:, None, :], books.entries[part])
    code = squares.argmin(axis=1)  # of equal distances the lower index
    best = np.take_along_axis(squares, code[:, None], 1)[:, 0]
    k = squares.shape[1]
    b = min(b, k - 1)
    if not books.small or squares.dtype == object or b < 1:
        nothing = np.zeros((len(x), 0))
        return Bounds(code, nothing.astype(np.int64), nothing.astype(np.float32), np.zeros(len(x), np.float32)), best
    np.put_along_axis(squares, code[:, None], -1, 1)
    near = np.argsort(squares, axis=1)[:, 1 : b + 2]
    lower = _below(np.take_along_axis(squares, near, 1))
    outer = lower[:, b] if b + 1 < k else np.full(len(x), np.inf, np.float32)
    return Bounds(code, near[:, :b], lower[:, :b], outer), best


def _improve(x: np.ndarray, part: np.ndarray, books: Codebooks, moves: np.ndarray, held: Bounds) -> tuple[Bounds, np.ndarray, int]:
    """Bounds and distances after the entries moved, and how many of the bounds were looked behind."""
    own = _squares(x, books.entries[part, held.code])
    b = held.near.shape[1]
    loosened = held.lower - moves[part[:, None], held.near]
    outer = held.outer - moves.max(axis=1)[part]
    lower = np.maximum(_ascending(loosened, outer), 0)
    # A bound that equals the distance decides nothing: the other entry may have the lower index.
    behind = (lower * lower * (1 - 1e-9) <= own[:, None].astype(np.float64)).sum(axis=1)
    code, near, kept = held.code.copy(), held.near.copy(), _single(lower[:, :b])
    best = own.copy()
    outer = _single(lower[:, b])

    some = np.flatnonzero((behind > 0) & (behind <= b))
    if len(some):
        most = int(behind[some].max())
        ids = np.concatenate([code[some, None], near[some, :most]], axis=1)
        squares = _squares(x[some, None, :], books.entries[part[some, None], ids])
        looked = np.arange(most + 1)[None, :] <= behind[some, None]
        squares = np.where(looked, squares, LARGEST)
        # By distance, then index; entries that were not looked at keep their places behind.
        rank = np.argsort(np.where(looked, ids, books.entries.shape[1] + np.arange(most + 1)), axis=1, kind="stable")
        rank = np.take_along_axis(rank, np.argsort(np.take_along_axis(squares, rank, 1), axis=1, kind="stable"), 1)
        ids, squares, looked = (np.take_along_axis(a, rank, 1) for a in (ids, squares, looked))
        code[some], best[some] = ids[:, 0], squares[:, 0]
        near[some, :most] = ids[:, 1:]
        exact = np.where(looked[:, 1:], _below(squares[:, 1:]), kept[some, :most])
        kept[some, :most] = exact
    every = np.flatnonzero(behind > b)
    if len(every):
        found, best[every] = _search(x[every], part[every], books, b)
        code[every], near[every], kept[every], outer[every] = found.code, found.near, found.lower, found.outer
    return Bounds(code, near, kept, outer), best, int(behind.max(initial=0))


def assign(x: np.ndarray, books: Codebooks, moves: np.ndarray | None, held: Bounds | None) -> tuple[Bounds, np.ndarray]:
    """Codes and bounds for vectors of shape (vectors, parts, width), and exact squared distances."""
    n, parts, width = x.shape
    flat, part = x.reshape(n * parts, width), np.tile(np.arange(parts), n)
    if not (books.small and x.dtype != object and _fits(x, parts * width)):
        flat = flat.astype(object)
        found, squares = _search(flat, part, Codebooks(books.entries.astype(object), False), 0)
    elif held is None or not held.near.shape[1]:
        found, squares = _search(flat, part, books, FIRST_BOUNDS)
    else:
        found, squares, looked = _improve(flat, part, books, moves, held)
        b = min(held.near.shape[1], max(LEAST_BOUNDS, looked))
        if b < found.near.shape[1]:  # the first bound that is left out bounds the rest as well
            outer = np.minimum(found.lower[:, b], found.outer)
            found = Bounds(found.code, found.near[:, :b], found.lower[:, :b], outer)
    # An exact distance may lie above a bound that follows.
    found.lower = _ascending(found.lower, found.outer)[:, :-1]
    return found, squares.reshape(n, parts)


def _lists(values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    flat = np.ascontiguousarray(values).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * (len(flat) // max(n, 1)), pa.int32()), pa.array(flat, kind))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


STATE = "code array<smallint>, near array<smallint>, lower array<float>, outer array<float>"


def _portions(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``most`` rows that all hold as many bounds."""
    for batch in batches:
        cuts = [0, batch.num_rows]
        if "near" in batch.schema.names:
            sizes = batch.column("near").value_lengths().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            for at in range(begin, end, most):
                yield batch.slice(at, min(most, end - at))


def _assigned(batches: Iterator[pa.RecordBatch], books: Codebooks, moves: np.ndarray | None) -> Iterator[tuple]:
    parts, _, width = books.entries.shape
    for batch in _portions(batches, max(1, PORTION * 4 // width)):
        n = batch.num_rows
        if not n:
            continue
        x = integers(_matrix(batch.column("embedding"), n)).reshape(n, parts, width)
        held = None
        if moves is not None:
            code = _matrix(batch.column("code"), n).astype(np.int64).reshape(-1)
            near = _matrix(batch.column("near"), n).astype(np.int64).reshape(n * parts, -1)
            lower = _matrix(batch.column("lower"), n).reshape(n * parts, -1)
            held = Bounds(code, near, lower, _matrix(batch.column("outer"), n).reshape(-1))
        yield batch, x, *assign(x, books, moves, held)


def _with_state(rows: DataFrame, books: Codebooks, moves: np.ndarray | None) -> DataFrame:
    """The vectors with their codes and bounds."""
    kept = ["vec_id", "label", "embedding"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x, found, _ in _assigned(batches, books, moves):
            n = batch.num_rows
            state = [
                _lists(found.code, n, pa.int16()),
                _lists(found.near, n, pa.int16()),
                _lists(found.lower, n, pa.float32()),
                _lists(found.outer, n, pa.float32()),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *state], [*kept, "code", "near", "lower", "outer"])

    return rows.mapInArrow(run, ", ".join([_ddl(rows, kept), STATE]))


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _sums(state: DataFrame, books: Codebooks) -> dict[tuple[int, int, int], int]:
    """Sums of the assigned parts' components by part, entry and position; position -1 holds the count."""
    parts, entries, width = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts * entries, width + 1), object)
        part = np.arange(parts)[None, :] * entries
        for batch in _portions(batches, PORTION * 8):
            n = batch.num_rows
            if not n:
                continue
            x = integers(_matrix(batch.column("embedding"), n)).reshape(n * parts, width)
            cell = (_matrix(batch.column("code"), n).astype(np.int64) + part).reshape(-1)
            totals[:, width] += np.bincount(cell, minlength=parts * entries)
            if x.dtype == object or not _fits(x, n * parts):
                np.add.at(totals, (cell[:, None], np.arange(width)[None, :]), x)
            else:
                sums = np.zeros((parts * entries, width), np.int64)
                np.add.at(sums, cell, x)
                totals[:, :width] += sums
        out: list[tuple[int, int, int, int, int]] = []
        for cell, at in zip(*np.nonzero(totals)):
            left, digit = int(totals[cell, at]), 0
            while not -DIGIT < left < DIGIT:
                left, low = divmod(left, DIGIT)
                out.append((cell // entries, cell % entries, at if at < width else -1, digit, low))
                digit += 1
            out.append((cell // entries, cell % entries, at if at < width else -1, digit, left))
        columns = list(zip(*out)) or [()] * 5
        names = ["part", "entry", "at", "digit", "total"]
        yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], pa.int64()) for c in columns], names)

    rows = (
        state.select("embedding", "code")
        .mapInArrow(add, "part long, entry long, at long, digit long, total long")
        .groupBy("part", "entry", "at", "digit")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"))
        .collect()  # a few rows for each component of a codebook
    )
    sums: dict[tuple[int, int, int], int] = {}
    for row in rows:
        key = (row["part"], row["entry"], row["at"])
        sums[key] = sums.get(key, 0) + int(row["total"]) * DIGIT ** row["digit"]
    return sums


def _replaced(books: Codebooks, sums: dict[tuple[int, int, int], int]) -> Codebooks:
    """Codebooks of floored means; entries without parts stay."""
    entries = books.entries.astype(object).copy()
    for part, entry, at in np.ndindex(entries.shape):
        count = sums.get((part, entry, -1), 0)
        if count:
            entries[part, entry, at] = sums.get((part, entry, at), 0) // count
    return Codebooks.of(entries)


def usable(vectors: DataFrame, parts: int) -> DataFrame:
    """``vec_id``, ``embedding``, ``label`` of the vectors whose components are all finite numbers."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    wanted = "array<float>" if kind == "float" else "array<double>"
    rows = vectors.select("vec_id", F.col("embedding").cast(wanted).alias("embedding"), "label")
    finite: Column = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast(wanted[6:-1]))
    )
    n = F.size("embedding")
    return rows.where(F.col("embedding").isNotNull() & (n > 0) & (n % parts == 0)).where(finite)


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, label, code, error`` of every kept vector, and the codebooks (none without vectors).

    ``code`` lists the entry of each part; ``error`` is the sum of the squared distances.
    """
    ship_code(vectors.sparkSession)
    rows = usable(vectors, parts)
    in_order = (F.col("vec_id").asc_nulls_last(), "embedding")
    first = rows.orderBy(*in_order).limit(entries).collect()
    if not first:
        empty = rows.limit(0).select("vec_id", "label", F.lit(None).cast("array<smallint>").alias("code"))
        return empty.withColumn("error", F.lit(None).cast("long")), None
    dims = len(first[0]["embedding"])
    rows = rows.where(F.size("embedding") == dims)
    if any(len(row["embedding"]) != dims for row in first):
        first = rows.orderBy(*in_order).limit(entries).collect()
    seeds = integers(np.array([row["embedding"] for row in first], np.float64)).astype(object)
    books = Codebooks.of(seeds.reshape(len(first), parts, dims // parts).swapaxes(0, 1))

    spark, state, moves, before = rows.sparkSession, rows, None, None
    for _ in range(rounds):
        path = new_folder(spark, "vector-bounds")
        state = stored_at(_with_state(state, books, moves), path)
        if before:
            drop_folder(spark, before)  # the new state holds all that is needed
        old, books, before = books, _replaced(books, _sums(state, books)), path
        moves = books.moves(old)
    last = books

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, found, squares in _assigned(batches, last, moves):
            n = batch.num_rows
            errors = [int(e) if e <= LARGEST else None for e in squares.sum(axis=1).tolist()]
            columns = [batch.column("vec_id"), batch.column("label"), _lists(found.code, n, pa.int16()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return state.mapInArrow(final, f"{_ddl(rows, ['vec_id', 'label'])}, code array<smallint>, error long"), books


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codes(read_table(spark, sf_dir, "embeddings"))
    found = stored(found, "vector-codes")  # read twice below
    known = F.count("*") == F.count("error")
    by_label = found.groupBy(F.col("label").alias("of_label")).agg(
        F.when(known, F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error")
    )
    digits = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0"))
    return found.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        F.col("label_error").try_cast("long").alias("label_error"),
        F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"),
    )


def _op13_check() -> str:
    """Two rounds over four-component parts, as the given tables have them, written out in SQL."""
    square = " + ".join(f"(x.v[{at}] - c.v[{at}]) * (x.v[{at}] - c.v[{at}])" for at in range(1, 5))
    means = ", ".join(f"CAST(floor(sum(v[{at}])::HUGEINT / count(*)) AS BIGINT)" for at in range(1, 5))
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT x.r, x.p, any_value(x.v) AS v, arg_min(c.e, ({square}) * 64 + c.e) AS e, min({square}) AS d
  FROM parts x JOIN c{n} c ON c.p = x.p GROUP BY x.r, x.p
)""")
        if n < ROUNDS:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.v, c.v) AS v
  FROM c{n} c LEFT JOIN (SELECT p, e, [{means}] AS v FROM a{n} GROUP BY p, e) m ON m.p = c.p AND m.e = c.e
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
  SELECT r, p, v[4 * p + 1 : 4 * p + 4] AS v FROM kept CROSS JOIN (SELECT unnest(range({PARTS})) AS p)
),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {ENTRIES}),
{", ".join(steps)},
coded AS (
  SELECT k.vec_id, k.label, k.r,
         string_agg(lpad(lower(to_hex(a.e)), 2, '0'), '' ORDER BY a.p) AS code, CAST(sum(a.d) AS BIGINT) AS error
  FROM kept k JOIN a{ROUNDS} a ON a.r = k.r GROUP BY k.vec_id, k.label, k.r
),
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded CROSS JOIN books
"""


OP13_CHECK = _op13_check()
