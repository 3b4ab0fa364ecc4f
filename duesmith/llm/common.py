"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space, tab, line feed, vertical tab, form feed and carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


#: Bytes of an Arrow batch: what a task holds of its texts at once, in the JVM and in Python.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_code(spark: SparkSession) -> None:
    """Give executors this package, once for each application, as ``--py-files`` would.

    The session's Arrow batches become small as well; their default of 64 MB is held several times
    over by each task, on either side.
    """
    spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory()
    package = Path(__file__).resolve().parents[1]
    archive = Path(folder.name) / f"{package.name}_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty), whatever else the table has."""
    return docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def unused_name(name: str, docs: DataFrame) -> str:
    """``name``, with as many underscores as it takes to be no column of ``docs``."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def last_at_most(values: Column, wanted: Column, at: str | None = None, bits: int = 20) -> Column:
    """How many leading elements of the sorted array ``values`` are at most ``wanted``.

    A binary search of ``bits`` steps, so arrays may hold up to ``2**bits - 1`` elements.
    ``at`` names the field to compare when the elements are structs.
    """

    def fits(position: Column) -> Column:
        element = F.get(values, position - 1)
        return (element[at] if at else element) <= wanted

    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= F.size(values)) & F.coalesce(fits(low + step), F.lit(False)), low + step
        ).otherwise(low),
    )


def texts_of(column: pa.Array, most: int = 256) -> Iterator[tuple[int, list[str]]]:
    """A text column in short lists, each with the number of its first row; null: empty."""
    for begin in range(0, len(column), most):
        yield begin, [text or "" for text in column.slice(begin, most).to_pylist()]


def in_portions(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items whose sizes add up to about ``most``; a larger item stands alone."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
