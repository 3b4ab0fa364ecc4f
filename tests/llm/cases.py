"""Documents that every operator must cope with."""

from __future__ import annotations

import duckdb

SMALL = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000

#: Nulls, empty and blank texts, a very long one, ties, repeated rows.
ROWS = [
    (1, "one two three four five six seven"),
    (2, "one  two\tthree four five six seven"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (None, "a text without a number"),
    (None, "a text without a number"),
    (7, "the same row twice"),
    (7, "the same row twice"),
    (7, "another text under the same number"),
    (8, "Ünïcode 日本語 😀 <|endoftext|> it's 12345 done"),
    (None, None),
]
#: Extra columns whose names operators might use themselves.
CLASHING = ("score", "row_key", "keep_id", "bucket", "fp", "length", "rank_", "toxic_", "html", "again", "stay_id")


def documents(spark, rows=None):
    rows = ROWS if rows is None else rows
    names = "".join(f", {name} string" for name in CLASHING)
    return spark.createDataFrame(
        [(i, text, *["x"] * len(CLASHING)) for i, text in rows], f"doc_id long, text string{names}"
    )


def nothing(spark):
    return documents(spark, [])


def rows_of(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def duck(sql: str, sf_dir: str = SMALL, documents=None):
    connection = duckdb.connect()
    if documents is None:
        connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    else:
        connection.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        connection.executemany("INSERT INTO documents VALUES (?, ?)", documents)
    return connection.sql(sql)


def tuples(relation, *columns):
    return sorted((tuple(row) for row in relation.project(", ".join(columns)).fetchall()), key=repr)
