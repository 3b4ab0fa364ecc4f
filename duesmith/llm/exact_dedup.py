"""Exact dedup by a content sort.

Normalised texts are dealt to buckets by sampled splitters, so that each bucket holds a range of
the sort order; buckets are sorted externally, which places equal texts next to each other; each
row is then compared, over its full text, with the row before it.  A run of equal rows is a group.

The order is: the text's first characters, its digest, the whole text, the identifier.  Splitters
carry all of these but the whole text, so they are small, and a text that many rows share spreads
over several buckets by identifier.  Runs that touch a bucket's border are put together afterwards
by their full text; there are at most two for each bucket.

Only DataFrame functions are used.  Null and empty texts are one group.  A null identifier counts as
larger than any other; of repeated rows exactly one is kept.  An empty table gives no rows.  Other
columns are ignored, or carried along by ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duesmith.llm.common import BLANKS, last_at_most, read_table, unused_name
from duesmith.sources.workspace import stored

#: Characters of a text that a splitter carries.
SPLITTER_CHARS = 256
#: Bytes of text for each bucket, and limits on the number of buckets.
BUCKET_BYTES = 64 << 20
MOST_BUCKETS = 16_384
#: Sampled rows for each bucket.
SAMPLE_EACH = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _sort_key(text: Column, doc_id: Column) -> Column:
    return F.struct(
        F.left(text, F.lit(SPLITTER_CHARS)).alias("head"),
        F.sha2(text, 256).alias("digest"),
        doc_id.isNull().alias("last"),
        doc_id.alias("doc_id"),
    )


def _splitters(rows: DataFrame, buckets: int, n_rows: int) -> DataFrame:
    """One row: the sorted keys at which buckets 1, 2, ... begin."""
    fraction = min(1.0, SAMPLE_EACH * buckets / max(n_rows, 1))
    sample = rows.sample(fraction=fraction, seed=1).select(_sort_key(F.col("text"), F.col("doc_id")).alias("key"))
    every = F.transform(
        F.sequence(F.lit(1), F.lit(buckets - 1)),
        lambda i: F.get("keys", F.floor(i * F.size("keys") / F.lit(buckets)).cast("int")),
    )
    return sample.agg(F.sort_array(F.collect_list("key")).alias("keys")).select(
        F.when(F.size("keys") > 0, every).otherwise(F.slice("keys", 1, 0)).alias("splitters")
    )


def equal_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), normalised(F.col(text_column)).alias("text"))
    totals = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text_column)).alias("bytes")).first()
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), (totals["bytes"] or 0) // BUCKET_BYTES, 2)
    buckets = min(buckets, MOST_BUCKETS)
    splitters = _splitters(rows, buckets, totals["n"])
    # At most MOST_BUCKETS short keys; as a constant they reach every task with the plan.
    constant = F.from_json(
        F.lit(splitters.select(F.to_json("splitters")).first()[0]), splitters.schema["splitters"].dataType
    )
    bucket = last_at_most(constant, _sort_key(F.col("text"), F.col("doc_id")), bits=buckets.bit_length())
    dealt = rows.withColumn("bucket", bucket).repartitionById(buckets, F.col("bucket"))
    in_order = Window.partitionBy("bucket").orderBy(
        F.left("text", F.lit(SPLITTER_CHARS)), "text_sha256", "text", F.col("doc_id").asc_nulls_last()
    )
    compared = dealt.withColumn("text_sha256", F.sha2("text", 256)).select(
        "bucket",
        "doc_id",
        "text_sha256",
        F.row_number().over(in_order).alias("position"),
        F.coalesce(F.lag("text").over(in_order) != F.col("text"), F.lit(True)).alias("first"),
        F.lead(F.lit(True)).over(in_order).isNull().alias("end"),
        "text",
    )
    placed = compared.select(
        "bucket",
        "doc_id",
        "text_sha256",
        "first",
        F.sum(F.col("first").cast("int"))
        .over(Window.partitionBy("bucket").orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
        .alias("run"),
        F.when((F.col("position") == 1) | F.col("end"), F.col("text")).alias("border"),
    )
    placed = stored(placed, "content-sort")

    run = Window.partitionBy("bucket", "run")
    local = placed.drop("border").select(
        "*", F.min("doc_id").over(run).alias("keep_id"), F.count("*").over(run).alias("group_size")
    )
    at_border = placed.where(F.col("border").isNotNull()).groupBy("bucket", "run").agg(F.max("border").alias("border"))
    parts = (
        placed.join(at_border.select("bucket", "run"), ["bucket", "run"], "left_semi")
        .groupBy("bucket", "run")
        .agg(F.min("doc_id").alias("part_id"), F.count("*").alias("part_size"))
        .join(at_border, ["bucket", "run"])
    )
    wholes = (
        parts.groupBy("border")
        .agg(
            F.min("part_id").alias("whole_id"),
            F.sum("part_size").alias("whole_size"),
            F.min("bucket").alias("first_bucket"),
            F.count("*").alias("n_parts"),
        )
        .where("n_parts > 1")
    )
    put_together = stored(
        parts.join(wholes, "border").select("bucket", "run", "whole_id", "whole_size", "first_bucket"), "split-groups"
    )
    begins = F.col("first") & F.coalesce(F.col("bucket") == F.col("first_bucket"), F.lit(True))
    return local.join(put_together, ["bucket", "run"], "left").select(
        "doc_id",
        F.when(F.col("first_bucket").isNull(), F.col("keep_id")).otherwise(F.col("whole_id")).alias("keep_id"),
        F.coalesce("whole_size", "group_size").alias("group_size"),
        begins.alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when equal texts are reduced to one."""
    key, digest, again = (unused_name(name, docs) for name in ("stay_id", "stay_digest", "again"))
    stay = equal_texts(docs, id_column, text_column).where("kept").select(
        F.col("doc_id").alias(key), F.col("text_sha256").alias(digest)
    )
    same = docs[id_column].eqNullSafe(stay[key]) & (F.sha2(normalised(docs[text_column]), 256) == stay[digest])
    # Rows that agree in id and text are repeats of one row.
    repeats = Window.partitionBy(key, digest).orderBy(key)
    joined = docs.join(stay, same).withColumn(again, F.row_number().over(repeats))
    return joined.where(F.col(again) == 1).select(*docs.columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_texts(read_table(spark, sf_dir, "documents"))


OP1_CHECK = r"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM plain
"""
