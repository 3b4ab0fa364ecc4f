"""Token counts by the whole-token shortcut.

Before any text is read, every vocabulary string is checked once: which ones does the library
encode, alone, as a single token?  Pre-tokens among them count as one.  Only the others are merged
by the library, and each worker remembers their counts in a table of bounded size.

Work is one scan without a shuffle.  Null and empty texts have no tokens; a null or repeated
``doc_id`` gives a row like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith.llm.common import id_and_text, read_table, ship_code, texts_of
from duesmith.llm.pieces import encoder, prove_whole_tokens

TOKENIZER = "byte_bpe_50k.json"


def token_counts(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every text, as the tokenizer library counts them.

    Special strings inside a text are handled as the library does by default; nothing is added,
    cut or padded.  The file must hold a byte-level BPE with the usual splitting pattern.
    """
    ship_code(docs.sparkSession)
    whole = prove_whole_tokens(tokenizer_path)
    rows = id_and_text(docs, id_column, text_column)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = encoder(tokenizer_path, whole).counts
        for batch in batches:
            numbers = [n for _, texts in texts_of(batch.column("text")) for n in counts(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(numbers, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text").mapInArrow(
        count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint"
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)
