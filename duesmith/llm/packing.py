"""Best-fit packing, planned on the histogram of lengths.

Texts become token pieces of at most ``capacity`` tokens.  How full each sequence gets depends
only on how many pieces there are of each length, so best-fit decreasing runs over those counts
(at most ``capacity`` numbers, whatever the size of the corpus) and yields, for each length, ranges
of ranks with the place of their first piece.  Pieces then get their rank within their length and
take the planned place by a join.

Ranks are numbered in chunks of pieces dealt by a hash, with a running sum over chunk counts, so
that a length which a third of all pieces share is spread over many tasks.

Null and empty texts are the end token alone.  A null ``doc_id`` is packed like any other, repeated
rows are packed as often as they occur, an empty table gives no pieces, other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duesmith.llm.common import id_and_text, last_at_most, read_table, ship_code, texts_of
from duesmith.llm.pieces import encoder, prove_whole_tokens
from duesmith.sources.workspace import stored

CAPACITY = 2048
END_ID = 0
#: Pieces that one task numbers together.
RANK_CHUNK = 10_000
TOKENIZER = "byte_bpe_50k.json"


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece of every document.

    A document's tokens are those of its text and ``end_id``.  Longer documents are cut from the
    back, so that the first piece takes what does not fill a whole one.
    """
    ship_code(docs.sparkSession)
    whole = prove_whole_tokens(tokenizer_path)
    rows = id_and_text(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, whole).ids
        for batch in batches:
            source: list[int] = []
            out: list[tuple[int, int, int, int]] = []
            kept: list[np.ndarray] = []
            tokens = ((begin + i, ids) for begin, texts in texts_of(batch.column("text")) for i, ids in enumerate(encode(texts)))
            for row, ids in tokens:
                ids = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
                begin, end = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while begin < len(ids):
                    part = ids[begin:end]
                    source.append(row)
                    out.append((piece, begin, len(part), zlib.crc32(part)))
                    if with_ids:
                        kept.append(part)
                    begin, end, piece = end, end + capacity, piece + 1
            piece, start, length, crc = (list(x) for x in zip(*out, strict=True)) if out else ([], [], [], [])
            columns = [
                batch.column("doc_id").take(pa.array(source, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([k.tolist() for k in kept], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int]]]:
    """Best-fit decreasing over counts: {length: [(first rank, pieces a sequence, first sequence, offset)]}.

    Ranks from one first rank up to the next take consecutive sequences, each that many pieces in
    a row, the first at the offset.  Open sequences are kept as ranges of numbers by free space;
    sequences of one range are alike, so a whole range takes pieces of one length in one step.
    """
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan: dict[int, list[tuple[int, int, int, int]]] = {}
    room: dict[int, list[tuple[int, int]]] = {}  # free space -> ranges of sequences
    spaces: list[int] = []
    opened = 0

    def put(space: int, begin: int, end: int) -> None:
        if space and begin < end:
            if space not in room:
                room[space] = []
                insort(spaces, space)
            room[space].append((begin, end))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        slots = plan[length] = []
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                each = capacity // length
                space, begin, end = capacity, opened, opened + -(-left // each)
                opened = end
            else:
                space = spaces[at]
                begin, end = room[space].pop()
                if not room[space]:
                    del room[space], spaces[at]
            each = space // length
            full = min(end - begin, left // each)
            if full:
                slots.append((rank, each, begin, capacity - space))
                rank, left = rank + full * each, left - full * each
                put(space - each * length, begin, begin + full)
            rest = begin + full
            if left and rest < end:  # fewer than one sequence takes
                slots.append((rank, left, rest, capacity - space))
                put(space - left * length, rest, rest + 1)
                rank, left, rest = rank + left, 0, rest + 1
            put(space, rest, end)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (stored; with ``doc_id``, ``piece`` and ``length``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = [
        (length, [tuple(slot) for slot in slots]) for length, slots in plan_sequences(histogram, capacity).items()
    ]
    slot = "struct<first_rank: bigint, each: bigint, sequence: bigint, offset: bigint>"
    plan = spark.createDataFrame(rows, f"length bigint, slots array<{slot}>")

    chunks = -(-max(sum(histogram.values()), 1) // RANK_CHUNK)
    # By all that tells pieces apart, so that null and repeated ids are dealt like others.
    apart = [name for name in ("doc_id", "piece", "start", "length", "ids_crc32") if name in pieces.columns]
    dealt = pieces.withColumn("chunk_", F.pmod(F.xxhash64(*apart), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "chunk_")
        .agg(F.count("*").alias("n_"))
        .select("length", "chunk_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    )
    inside = Window.partitionBy("length", "chunk_").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("nth_", F.row_number().over(inside))
        .join(offsets, ["length", "chunk_"])
        .withColumn("rank_", F.col("before_") + F.col("nth_") - 1)
    )
    placed = ranked.join(plan, "length").withColumn(
        "slot_", F.get("slots", last_at_most(F.col("slots"), F.col("rank_"), "first_rank") - 1)
    )
    turn = F.col("rank_") - F.col("slot_.first_rank")
    return placed.select(
        *pieces.columns,
        (F.col("slot_.sequence") + F.expr("(rank_ - slot_.first_rank) div slot_.each")).alias("sequence_id"),
        (F.col("slot_.offset") + (turn % F.col("slot_.each")) * F.col("length")).alias("offset"),
    )


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and its token ``ids`` from packed pieces that carry ids; at most one capacity each."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(in_order, lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(token_pieces(docs, tokenizer_path, capacity), "token-pieces"), capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
