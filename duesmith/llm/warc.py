"""WARC archives with revisit records, and an index of captures merged from sorted runs.

* **Writing.** One record for each page, in the text form that the format prescribes: header lines,
  an empty line, the payload, and two line breaks, which Spark's text writer puts after each row.
  Of equal payloads the capture with the largest ``page_id`` is written in full, the others are
  revisits that name it.  Digests are summed per payload before they meet the pages again, so a
  payload that very many pages share is one row of that join.
* **Reading.** Files are parsed by ``Content-Length``; a revisit's payload is that of the record
  it refers to.
* **Index.** Each file's captures form a run sorted by URL key, time and page.  Runs are dealt to
  ranges of that order and merged in each range by a loser tree, which gives capture histories in
  global order.

Null and empty payloads are equal to each other.  A null ``url`` is written as an empty target.
A null ``page_id`` takes part as a capture without a number; repeated rows are separate captures.
An empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith.llm.common import read_table, ship_code
from duesmith.sources.workspace import new_folder, stored

BREAK = "\r\n"
AFTER_RECORD = BREAK * 2
#: Bytes of payload that one archive file should hold.
FILE_BYTES = 16 << 20
#: Payloads smaller than this are always written in full.
LEAST_REVISIT = 0
#: Time of page 0; each page is one second later.
FIRST_CAPTURE = "2024-01-01 00:00:00"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    fours = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digests(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest``."""
    rows = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    return rows.select(
        "*",
        F.octet_length("html").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("html").cast("binary")).alias("payload_digest"),
    )


def with_revisits(signed: DataFrame, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """``record_type`` and ``refers_to`` of every capture.

    Payloads count as equal when length and digest agree.  Repeated rows of the largest page are
    all written in full, as nothing could tell a revisit from its original.
    """
    keys = ["payload_digest", "payload_bytes"]
    latest = signed.groupBy(*keys).agg(F.max("page_id").alias("latest"))
    again = (
        (F.col("payload_bytes") >= least_bytes)
        & F.col("latest").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("latest"))
    )
    return signed.join(latest, keys).select(
        "page_id",
        "url",
        "html",
        *reversed(keys),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("latest")).alias("refers_to"),
    )


def _date(page_id: str) -> Column:
    at = F.expr(f"timestamp_seconds(unix_timestamp(timestamp'{FIRST_CAPTURE}') + coalesce({page_id}, 0))")
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _name(page_id: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(">"))


def write_archives(captures: DataFrame, path: str, records_each: int) -> None:
    """Write ``with_revisits`` rows as gzip-compressed WARC files of at most so many records."""
    body = F.when(F.col("record_type") == "response", F.col("html")).otherwise("")
    # A target must stay on its header line.
    target = F.regexp_replace("url", r"[\r\n]", "%0A")
    headers = F.concat_ws(
        BREAK,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), _name("page_id")),
        F.concat(F.lit("WARC-Date: "), _date("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.when(
            F.col("record_type") == "revisit",
            F.concat_ws(
                BREAK, F.lit(f"WARC-Profile: {_PROFILE}"), F.concat(F.lit("WARC-Refers-To: "), _name("refers_to"))
            ),
        ),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
        F.lit(BREAK),
    )
    (
        captures.select(F.concat(headers, body).alias("value"))
        .write.option("lineSep", AFTER_RECORD)
        .option("maxRecordsPerFile", records_each)
        .option("compression", "gzip")
        .text(path)
    )


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """Headers, place in the (uncompressed) file and block of each record."""
    at = 0
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        first, *lines = content[at:head].decode("utf-8").split(BREAK)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        begin = head + 4
        end = begin + int(fields["Content-Length"])
        if content[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} has a wrong length")
        yield fields, at, content[begin:end]
        at = end + 4


def _number(name: str | None) -> int | None:
    digits = name.removeprefix("<urn:page:").rstrip(">") if name else ""
    return int(digits) if digits else None


_RECORD = (
    "page_id bigint, url string, captured string, record_type string, refers_to bigint, declared string, "
    "bytes bigint, digest string, file string, place bigint"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row for each record: headers, place, and length and digest measured on its block."""
    ship_code(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                plain = zlib.decompress(content.as_buffer(), wbits=47)
                rows = []
                for fields, place, block in parse_archive(plain):
                    rows.append(
                        (
                            _number(fields["WARC-Record-ID"]),
                            fields["WARC-Target-URI"],
                            fields["WARC-Date"],
                            fields["WARC-Type"],
                            _number(fields.get("WARC-Refers-To")),
                            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            len(block),
                            base64.b32encode(hashlib.sha1(block).digest()).decode(),
                            file.as_py().rsplit("/", 1)[-1],
                            place,
                            *([block.decode("utf-8")] if with_payload else []),
                        )
                    )
                names = [part.split()[0] for part in _RECORD.split(", ")] + ["html"] * with_payload
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
                kinds = [pa.int64() if n in ("page_id", "refers_to", "bytes", "place") else pa.string() for n in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, _RECORD + (", html string" if with_payload else ""))


def resolved(records: DataFrame) -> DataFrame:
    """Each record (stored) with length and digest of the whole payload, revisits through what they refer to."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "captured", "file", "place"]
    own = records.withColumnsRenamed({"bytes": "payload_bytes", "digest": "payload_digest"}).select(*columns)
    full = own.where("record_type = 'response'")
    originals = full.groupBy(F.col("page_id").alias("original")).agg(
        F.max(F.struct("payload_bytes", "payload_digest")).alias("whole")
    )
    # A stored table next to the revisits leaves the join free to split a page that very many refer to.
    originals = stored(originals, "originals")
    again = own.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    revisits = again.join(originals, F.col("refers_to") == F.col("original"), "left")
    return full.unionByName(revisits.select("*", "whole.*").select(*columns))


def url_key(url: str) -> str:
    """Host labels from the top down, then the path and query: captures of a site sort together."""
    try:
        parts = urlsplit(url if "://" in url else f"//{url}")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}".lower()


class LoserTree:
    """Merge of sorted iterators; each step replays one path of matches from a leaf to the root."""

    _END = (2,)

    def __init__(self, runs: list[Iterator[tuple]]):
        self._runs = runs
        self._k = max(1, len(runs))
        self._heads = [self._pull(i) for i in range(len(runs))] or [self._END]
        self._losers = [-1] * self._k
        for leaf in range(self._k):
            self._replay(leaf)

    def _pull(self, run: int) -> tuple:
        item = next(self._runs[run], None)
        return self._END if item is None else (1, item, run)

    def _replay(self, winner: int) -> None:
        """Play the winner's path; while the tree is built, the first to reach a match waits there."""
        node = (winner + self._k) // 2
        while node:
            rival = self._losers[node]
            if rival < 0:
                self._losers[node] = winner
                return
            if self._heads[rival] < self._heads[winner]:
                self._losers[node], winner = winner, rival
            node //= 2
        self._losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self._heads[self._losers[0]]) != self._END:
            yield head[1]
            run = self._losers[0]
            self._heads[run] = self._pull(run)
            self._replay(run)


def capture_index(records: DataFrame) -> DataFrame:
    """``resolved`` records with ``url_key``, in global order of URL key, time and place.

    Each file is a run: it is sorted where it is read, dealt to ranges of the order, and merged
    with the other runs of its range.  A URL with very many captures spreads over several ranges.
    """
    spark = records.sparkSession
    ship_code(spark)
    key_of = F.pandas_udf(lambda urls: urls.map(url_key), "string")
    keyed = records.withColumn("url_key", key_of("url"))
    order = ["url_key", "captured", "file", "place"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = keyed.sortWithinPartitions(*order).repartitionByRange(parts, *order)
    columns = runs.columns
    file, key = columns.index("file"), [columns.index(name) for name in order]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[tuple]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                pieces.setdefault(row[file], []).append((tuple(row[i] for i in key), row))
        # Blocks of one run may arrive in any order; sorting what is nearly sorted takes one look.
        merged = iter(LoserTree([iter(sorted(run, key=lambda x: x[0])) for run in pieces.values()]))
        while part := list(islice(merged, 10_000)):
            rows = zip(*[row for _, row in part], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(rows, schema, strict=True)], schema=schema
            )

    return runs.mapInArrow(merge, runs.schema)


def archive(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` below ``path`` and give back the index of the records read from there."""
    spark = pages.sparkSession
    total = pages.agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("bytes")).first()
    records_each = max(1, total["n"] * FILE_BYTES // max(total["bytes"] or 0, 1))
    write_archives(with_revisits(digests(pages)), f"{path}/warc", min(records_each, 1 << 20))
    records = stored(read_archives(spark, f"{path}/warc"), "records")
    return capture_index(stored(resolved(records), "resolved-records"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(read_table(spark, sf_dir, "pages"), new_folder(spark, "archives")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP10_CHECK = """
WITH signed AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS digest
  FROM pages
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(digest, CAST(1 + 5 * (k // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31) AS INT),
         1)), '') AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM signed
WINDOW same AS (PARTITION BY payload)
"""
