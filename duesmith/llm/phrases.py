"""Phrase collocations from stripes: for each prefix an associative counter of the words that follow.

Level k has stripes whose prefixes are k - 1 words long, so an element of a stripe counts a phrase of
k words.  Tasks fill stripes from their texts, add those of one prefix up elementwise and ship them;
the merge adds the rows of a prefix up, again elementwise and as a stream, and keeps the elements that
stand often enough.  These are the extensions; a prefix's own total is its element in the stripe one
word shorter; and the largest element of a stripe (and, for words in front, of the stripes with the
same ending) says whether a longer phrase subsumes the prefix.

A phrase can only be frequent if what is left without its first or last word is, so a level counts
only windows whose two shorter windows are frequent.  Tasks ask a bit map of fixed size, filled by
hashes of the level below; a collision lets a window through to be counted, so counts are exact.  Stripes of
hot prefixes are cut into segments by a hash of the next word; the first level's, which have every
word of a language, into segments in proportion to the shuffle's partitions.

Texts are lower-cased in A-Z, split into pieces at marks and line ends, and these into words at
spaces and tabs; a null text is empty, a null language is ``und``.  Rows count as they stand, whatever
their ids; ties in the ranking go to the smaller phrase.  An empty table gives no rows, as does a
language without frequent phrases; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duesmith.llm.common import in_portions, read_table, ship_code
from duesmith.llm.words import Words, mix, words_of
from duesmith.sources.workspace import stored

LEAST_COUNT = 30
MOST_WORDS = 4
TOP = 2000
#: A phrase is subsumed by a longer one with at least this percentage of its occurrences.
SUBSUMED = 80
SCALE = 2_000_000

#: Bits of the map that tells frequent windows; it takes four megabytes whatever the corpus.
MAP_BITS = 25
#: Occurrences from which a prefix is hot, and the segments of its stripe.
HOT_COUNT, SEGMENTS = 1 << 20, 64
#: Elements of one shipped row, rows of one batch, and what a task adds up at once.
ROW_ELEMENTS, BATCH_ROWS = 128, 4096
HELD_ELEMENTS, HELD_WORDS, MERGED_ELEMENTS = 1_000_000, 300_000, 300_000
PORTION = 1 << 20

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
SEPARATOR = BREAK.copy()
SEPARATOR[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: A stripe on its way: its next words and their numbers, each joined by spaces, which no word holds.
STRIPE = "lang string, prefix string, segment int, next string, n string"
ELEMENT = "lang string, prefix string, next string, f bigint, place bigint"


def _lowered(column: pa.Array) -> pa.Array:
    """A-Z in lower case, all other bytes as they are."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if data is None:
        return column
    small = pa.py_buffer(_LOWER[np.frombuffer(data, np.uint8)])
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, offsets, small], offset=column.offset)


def _places(hashes: list[np.ndarray], lang: np.ndarray) -> np.ndarray:
    """Places in the bit map of windows, given the hashes of their first, second, ... words."""
    total = lang.copy()
    for h in hashes:
        total = mix(total + h)
    return (total >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _lang_hash(langs: list[str]) -> np.ndarray:
    return mix(np.array([zlib.crc32(lang.encode()) + 1 for lang in langs], np.uint64))


class Vocabulary:
    """Numbers for the words that a task holds, and for its languages."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.hashes: list[np.ndarray] = []

    def numbers(self, words: Words, at: np.ndarray) -> np.ndarray:
        """The numbers of some words of a portion."""
        encoded = _texts(words, at).dictionary_encode()
        local, texts = encoded.indices.to_numpy(), encoded.dictionary.to_pylist()
        ids, before = self.ids, len(self.ids)
        numbers = np.array([ids.setdefault(text, len(ids)) for text in texts], np.int32)
        hashes = np.zeros(len(texts), np.uint64)
        hashes[local] = words.hashes[at]
        self.hashes.append(hashes[numbers >= before])
        return numbers[local]

    def strings(self) -> pa.Array:
        return pa.array(list(self.ids), pa.string())

    def segments(self, segments: int) -> np.ndarray:
        return (np.concatenate(self.hashes) % np.uint64(segments)).astype(np.int32)


def _texts(words: Words, at: np.ndarray) -> pa.Array:
    """The texts of some words, cut out of the portion's bytes."""
    starts, ends = words.starts[at], words.ends[at]
    length = ends - starts
    edge = np.zeros(len(words.data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1]).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(words.data[inside])]
    return pa.Array.from_buffers(pa.large_string(), len(length), buffers)


def _known(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _windows(words: Words, lang_hash: np.ndarray, level: int, frequent: np.ndarray | None) -> np.ndarray:
    """Where windows of ``level`` words begin that lie in one piece and whose shorter windows are frequent."""
    n, text_of = len(words.starts), words.text_of
    if level == 1:
        return np.arange(n)
    breaks = np.concatenate([[0], np.cumsum(BREAK[words.data])])[words.starts]
    joined = (breaks[1:] == breaks[:-1]) & (text_of[1:] == text_of[:-1])
    whole = np.ones(max(n - level + 2, 0), bool)  # windows of level - 1 words within one piece
    for step in range(level - 2):
        whole &= joined[step : step + len(whole)]
    at = np.flatnonzero(whole)
    places = _places([words.hashes[at + step] for step in range(level - 1)], lang_hash[at])
    whole[at] = _known(frequent, places)
    return np.flatnonzero(whole[:-1] & whole[1:] & joined[level - 2 :])


def _summed(tables: list[pa.Table]) -> pa.Table:
    """Elements added up by all columns but their number."""
    table = pa.concat_tables(tables)
    keys = [name for name in table.column_names if name != "n"]
    summed = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return summed.rename_columns({"n_sum": "n"}).select([*keys, "n"])


def _rows(table: pa.Table, level: int, langs: list[str], words: Vocabulary, segments: int, hot: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The elements as rows of stripes, each with at most ``ROW_ELEMENTS``."""
    if not len(table):
        return
    ids = [table[f"w{k}"].to_numpy() for k in range(level)]
    lang, n, strings = table["lang"].to_numpy(), table["n"].to_numpy(), words.strings()
    segment = words.segments(segments)[ids[-1]]
    if level > 1:  # only stripes of hot prefixes are cut
        hashes = np.concatenate(words.hashes)
        places = _places([hashes[i] for i in ids[:-1]], _lang_hash(langs)[lang])
        segment = np.where(_known(hot, places), segment, 0) if hot is not None else np.zeros_like(segment)
    order = np.lexsort((segment, *reversed(ids[:-1]), lang))
    ids, lang, n, segment = [i[order] for i in ids], lang[order], n[order], segment[order]
    new = np.ones(len(order), bool)
    new[1:] = False
    for column in (lang, segment, *ids[:-1]):
        new[1:] |= column[1:] != column[:-1]
    begins = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    begins = np.flatnonzero(place % ROW_ELEMENTS == 0)
    if level == 1:
        prefixes = pa.array([""] * len(begins), pa.string())
    else:
        prefixes = pc.binary_join_element_wise(*[strings.take(pa.array(i[begins])) for i in ids[:-1]], " ")
    names = pa.array(langs, pa.string()).take(pa.array(lang[begins]))
    ends = np.append(begins, len(order))
    for begin in range(0, len(begins), BATCH_ROWS):
        end = min(begin + BATCH_ROWS, len(begins))
        part = slice(ends[begin], ends[end])
        offsets = pa.array(ends[begin : end + 1] - ends[begin], pa.int32())
        following = pc.binary_join(pa.ListArray.from_arrays(offsets, strings.take(pa.array(ids[-1][part]))), " ")
        counts = pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(n[part]).cast(pa.string())), " ")
        columns = [names.slice(begin, end - begin), prefixes.slice(begin, end - begin), pa.array(segment[begins[begin:end]], pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, following, counts], [*_KEY, "next", "n"])


_KEY = ["lang", "prefix", "segment"]


def _stripes(texts: DataFrame, level: int, frequent: np.ndarray | None, hot: np.ndarray | None, segments: int) -> DataFrame:
    """The stripes of each task, added up as far as it holds them together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for elements, langs, words in _added(batches, level, frequent):
            yield from _rows(elements, level, langs, words, segments, hot)

    return texts.mapInArrow(run, STRIPE)


def _added(batches: Iterator[pa.RecordBatch], level: int, frequent: np.ndarray | None) -> Iterator[tuple[pa.Table, list[str], Vocabulary]]:
    """Elements by number, added up until a task holds as many different ones or words as it may."""
    held: list[pa.Table] = []
    raw = 0
    words, langs = Vocabulary(), {}
    for batch in batches:
        lang = batch.column("lang").dictionary_encode()
        local = np.array([langs.setdefault(name, len(langs)) for name in lang.dictionary.to_pylist()], np.int32)
        of_text = local[lang.indices.to_numpy()]
        lang_hash = _lang_hash(list(langs))
        for portion in words_of(_lowered(batch.column("text")), SEPARATOR, portion=PORTION):
            if not len(portion.starts):
                continue
            of_word = of_text[portion.first + portion.text_of]
            at = _windows(portion, lang_hash[of_word], level, frequent)
            used = np.zeros(len(of_word), bool)
            for k in range(level):
                used[at + k] = True
            ids = np.zeros(len(of_word), np.int32)
            ids[used] = words.numbers(portion, np.flatnonzero(used))
            columns = {"lang": of_word[at]} | {f"w{k}": ids[at + k] for k in range(level)}
            held.append(pa.table(columns | {"n": np.ones(len(at), np.int64)}))
            raw += len(at)
            if raw > HELD_ELEMENTS or len(words.ids) > HELD_WORDS:
                held = [_summed(held)]
                raw = len(held[0])
                if raw > HELD_ELEMENTS // 2 or len(words.ids) > HELD_WORDS:
                    yield held.pop(), list(langs), words
                    raw, words, langs = 0, Vocabulary(), {}
                    local = np.array([langs.setdefault(name, len(langs)) for name in lang.dictionary.to_pylist()], np.int32)
                    of_text, lang_hash = local[lang.indices.to_numpy()], _lang_hash(list(langs))
    if held:
        yield _summed(held), list(langs), words


def _merge(stripes: DataFrame, level: int, least: int) -> DataFrame:
    """Whole stripes as elements that stand at least ``least`` times; level 1 adds each language's words."""

    def finished(table: pa.Table) -> pa.RecordBatch:
        """Frequent elements, with their place in the map of this level."""
        totals = table.group_by(["lang"]).aggregate([("n", "sum")]) if level == 1 else None
        table = table.filter(pc.greater_equal(table["n"], least)).combine_chunks()
        lang, prefix, following = (table[name].combine_chunks() for name in ("lang", "prefix", "next"))
        phrase = following if level == 1 else pc.binary_join_element_wise(prefix, following, " ")
        hashes = np.zeros((len(table), level), np.uint64)
        for words in words_of(phrase, SEPARATOR):
            hashes[words.first : words.first + len(words.cuts) - 1] = words.hashes.reshape(-1, level)
        codes = lang.dictionary_encode()
        salt = _lang_hash(codes.dictionary.to_pylist())[codes.indices.to_numpy()] if len(table) else np.zeros(0, np.uint64)
        columns = [lang, prefix, following, table["n"].combine_chunks(), pa.array(_places(list(hashes.T), salt), pa.int64())]
        if totals is not None:  # parts of what the stripe holds in all, as elements of the empty word
            nothing = pa.array([""] * len(totals), pa.string())
            parts = [totals["lang"], nothing, nothing, totals["n_sum"], pa.array([0] * len(totals), pa.int64())]
            columns = [pa.concat_arrays([c, *(p.chunks if isinstance(p, pa.ChunkedArray) else [p])]) for c, p in zip(columns, parts)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "next", "f", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: pa.Table | None = None  # the stripe that the next rows may go on with
        for batch in batches:
            sizes = pc.count_substring(batch.column("next"), " ").to_numpy(zero_copy_only=False) + 1
            for begin, end in in_portions(sizes.tolist(), MERGED_ELEMENTS):
                part = batch.slice(begin, end - begin)
                rows = pa.table({name: part.column(name) for name in _KEY})
                following, counts = (pc.split_pattern(part.column(name), " ").flatten() for name in ("next", "n"))
                table = pa.table({"next": following, "n": counts.cast(pa.int64())})
                owner = np.repeat(np.arange(len(rows)), sizes[begin:end])
                if open_ is not None:
                    rows = pa.concat_tables([open_.select(_KEY).slice(0, 1), rows])
                    table = pa.concat_tables([open_.select(["next", "n"]), table])
                    owner = np.concatenate([np.zeros(len(open_), np.int64), owner + 1])
                stripe = np.zeros(len(rows), np.int32)
                for name in _KEY:
                    codes = rows[name].combine_chunks().dictionary_encode().indices.to_numpy()
                    stripe[1:] |= codes[1:] != codes[:-1]
                stripe = np.cumsum(stripe, dtype=np.int32)
                words = table["next"].combine_chunks().dictionary_encode()
                summed = _summed([pa.table({"stripe": stripe[owner], "word": words.indices, "n": table["n"]})])
                first = np.searchsorted(stripe, np.arange(stripe[-1] + 1))
                keys = rows.take(pa.array(first[summed["stripe"].to_numpy()]))
                table = keys.append_column("next", words.dictionary.take(summed["word"])).append_column("n", summed["n"])
                last = summed["stripe"].to_numpy() == stripe[-1]
                open_ = table.filter(pa.array(last)).combine_chunks()
                yield finished(table.filter(pa.array(~last)))
        if open_ is not None:
            yield finished(open_)

    return stripes.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(run, ELEMENT)


def _bit_map(elements: DataFrame) -> np.ndarray:
    """The bits of the elements' places; at most ``2**MAP_BITS`` of them."""
    parts = (
        elements.where("next <> ''")
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    bits[parts["word"].to_numpy()] = parts["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return bits


def stripe_levels(docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT) -> list[DataFrame]:
    """For each level ``lang, prefix, next, f``: the frequent elements of its stripes."""
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    many = 4 * max(SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    levels: list[DataFrame] = []
    frequent = hot = None
    for level in range(1, most_words + 1):
        stripes = _stripes(texts, level, frequent, hot, many if level == 1 else SEGMENTS)
        levels.append(stored(_merge(stripes, level, least), f"stripes-{level}"))
        if level < most_words:
            frequent = _bit_map(levels[-1])
            hot = _bit_map(levels[-1].where(F.col("f") >= HOT_COUNT))
    return levels


def _exact(number: Column | str) -> Column:
    return (F.col(number) if isinstance(number, str) else number).cast("decimal(38,0)")


def collocations(docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    levels = stripe_levels(docs, most_words, least)
    totals = levels[0].where("next = ''").groupBy("lang").agg(F.sum("f").alias("n"))

    def counted(level: int) -> DataFrame:
        words = F.split("prefix", " ") if level > 1 else F.array().cast("array<string>")
        return (
            levels[level - 1]
            .where("next <> ''")
            .select("lang", F.concat(words, F.array("next")).alias("words"), F.col("f").alias("a"))
        )

    def phrase(words: Column) -> Column:
        return F.array_join(words, " ")

    every = counted(1)
    for level in range(2, most_words + 1):
        every = every.unionByName(counted(level))
    counts = every.select("lang", phrase(F.col("words")).alias("phrase"), F.col("a").alias("f"))
    candidates = every.where(F.size("words") > 1)
    # A longer phrase with more words around it never stands more often than one with a single word more.
    longer = candidates.where(F.size("words") > 2)
    size = F.size("words")
    shorter = F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))
    subsuming = (
        longer.select("lang", F.explode(F.transform(shorter, phrase)).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = (
        candidates.withColumn("phrase", phrase(F.col("words")))
        .join(subsuming, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (100 * _exact("longer") < SUBSUMED * _exact("a")))
    )
    cuts = kept.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang",
        "phrase",
        "a",
        "k",
        phrase(F.slice("words", F.lit(1), F.col("k"))).alias("first"),
        phrase(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("rest"),
    )
    first, rest = (counts.withColumnsRenamed({"phrase": part, "f": f}) for part, f in (("first", "l"), ("rest", "r")))
    scored = (
        cuts.join(first, ["lang", "first"])
        .join(rest, ["lang", "rest"])
        .withColumn("score", F.expr(f"cast({SCALE} * cast(a as decimal(28,0)) as decimal(38,0)) div cast(cast(l as decimal(20,0)) + r as decimal(38,0))"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("lowest"))
        .select("lang", "phrase", "a", "lowest.score", "lowest.l", "lowest.r")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


OP11_CHECK = rf"""
WITH pieces AS MATERIALIZED (
  SELECT lang, row_number() OVER () AS piece, body
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS body
    FROM documents
  )
),
words AS MATERIALIZED (
  SELECT lang, piece, list_filter(string_split_regex(body, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
counts AS MATERIALIZED (
  SELECT lang, words, count(*) AS f
  FROM (
    SELECT lang, w[i : i + k - 1] AS words
    FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
      FROM words CROSS JOIN (SELECT unnest(range(1, {MOST_WORDS + 1})) AS k)
    )
  )
  GROUP BY lang, words HAVING count(*) >= {LEAST_COUNT}
),
candidates AS MATERIALIZED (SELECT lang, words, f AS a FROM counts WHERE len(words) > 1),
parts AS (
  SELECT lang, words[i : i + k - 1] AS words, a
  FROM (
    SELECT lang, words, a, k, unnest(range(1, len(words) - k + 2)) AS i
    FROM (SELECT lang, words, a, unnest(range(2, len(words))) AS k FROM candidates)
  )
),
kept AS (
  SELECT c.lang, c.words, c.a
  FROM candidates c
  LEFT JOIN (SELECT lang, words, max(a) AS longer FROM parts GROUP BY lang, words) p
    ON p.lang = c.lang AND p.words = c.words
  WHERE p.longer IS NULL OR 100 * p.longer < {SUBSUMED} * c.a
),
cuts AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM kept),
scored AS (
  SELECT c.lang, array_to_string(c.words, ' ') AS phrase, c.a, c.k, l.f AS l, r.f AS r,
         CAST((({SCALE}::HUGEINT * c.a) // (l.f + r.f)) AS BIGINT) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.words = c.words[1 : c.k]
  JOIN counts r ON r.lang = c.lang AND r.words = c.words[c.k + 1 : len(c.words)]
),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score
FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= {TOP}
"""
