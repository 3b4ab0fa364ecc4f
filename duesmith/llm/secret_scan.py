"""Secrets in texts: fixed forms, and values in credential context that are costly to guess.

Three forms are searched as they are defined (assignments, access keys, long hexadecimal numbers).
A value that follows a credential word in some looser way is kept as well, as ``guess``, when the
cheapest split into words, dates, repeats, keyboard walks and random characters still takes at
least ``10 ** LEAST_COST`` guesses (``guessing``) and no span of the fixed forms touches it.  The words
are ranked by the documents of the corpus that have them, after a short fixed list; so an ordinary
word that follows a credential word is none, whatever the language.

One scan counts words, another one searches.  Null and empty texts have no spans; null or repeated ids give rows like
any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith.llm.common import id_and_text, read_table, ship_code, texts_of
from duesmith.llm.guessing import Words, guess_cost
from duesmith.sources.workspace import stored

KINDS = ("assign", "access", "hex", "guess")
#: Guesses, as a power of ten, from which a value counts as a secret.
LEAST_COST = 10.0
#: Words ranked at most, and documents that a word must stand in: a secret and its copies are no word.
MOST_WORDS, LEAST_DOCUMENTS = 30_000, 5
_FIXED = Words()

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32}")
_CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|passcode|pwd|secret|token|credentials?|api[_\x20-]?key|bearer)"""
    r"""["']?[\x20\t]*+(?:\b(?:is|was|are)\b|:=|=>|->|[:=])?[\x20\t]*+["'`<(]?([^\s"'`<>()]{6,}+)""",
    re.ASCII | re.IGNORECASE,
)
#: What each of the patterns with credential words needs, in lower case.
_WORDS = ("passw", "secret", "token", "apikey", "api_key", "passphrase", "passcode", "pwd", "credential", "api", "bearer")


def common_words(docs: DataFrame, most: int = MOST_WORDS) -> list[str]:
    """About ``most`` words of 3 to 20 letters a-z that the most documents have, in that order.

    Classes of like frequency are taken whole from the top; of the class at the border a hash chooses
    as many as there is room for.  So only the sizes of classes and the chosen words are collected.
    """
    found = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+"))
    counted = (
        docs.select(F.explode(found).alias("word"))
        .where(F.length("word").between(3, 20))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_DOCUMENTS)
    )
    counted = stored(counted, "word-counts").withColumn("class", F.floor(8 * F.log2("n")))
    sizes = {row["class"]: row["count"] for row in counted.groupBy("class").count().collect()}  # a few hundred
    room, border, share = most, -1, 0.0
    for level in sorted(sizes, reverse=True):
        if sizes[level] > room:
            border, share = level, room / sizes[level]
            break
        room -= sizes[level]
    by_hash = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))
    chosen = counted.where((F.col("class") > border) | ((F.col("class") == border) & by_hash)).collect()
    return [row["word"] for row in sorted(chosen, key=lambda row: (-row["n"], row["word"]))]


def _joined_up(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what spans cover together, from left to right."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((start, end) for _, start, end in spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def find_secrets(text: str, least_cost: float = LEAST_COST, words: Words = _FIXED) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then in the order of ``KINDS``."""
    spans: list[tuple[str, int, int]] = []
    low = text.lower()
    credential = any(word in low for word in _WORDS)
    if credential:
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if _LONG_HEX.search(text):
        spans += [("hex", *m.span()) for m in _HEX.finditer(text) if len(m[0]) >= 32]
    if credential:
        starts, ends = _joined_up(spans)
        costly: dict[str, bool] = {}  # a text may have one value many times
        for m in _CONTEXT.finditer(text):
            value = m[1].rstrip(".,;:!?]}")
            start, end = m.start(1), m.start(1) + len(value)
            before = bisect_left(starts, end) - 1  # of what begins before the value's end the last
            touched = before >= 0 and start < ends[before]
            if len(value) < 6 or touched:
                continue
            if value not in costly:
                costly[value] = guess_cost(value, words, least_cost) >= least_cost
            if costly[value]:
                spans.append(("guess", start, end))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def secret_spans(docs: DataFrame, least_cost: float = LEAST_COST) -> DataFrame:
    """``doc_id`` and ``found`` (kind, start, end, value) of every document."""
    ship_code(docs.sparkSession)
    words = common_words(docs)
    rows = id_and_text(docs)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    span = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = Words(words)
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e, "value": text[s:e]} for k, s, e in find_secrets(text, least_cost, ranked)]
                for _, texts in texts_of(batch.column("text"))
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, span)], ["doc_id", "found"])

    return rows.mapInArrow(
        search, f"doc_id {id_type}, found array<struct<kind: string, start: bigint, end: bigint, value: string>>"
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    found = F.col("found")
    return secret_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(of_kind, KINDS),
        F.sha2(joined(F.filter(found, lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
        joined(found).alias("spans"),
    )
