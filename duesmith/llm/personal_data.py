"""Personal data: fixed forms, and identifiers found through the contexts that fixed forms stand in.

E-mail addresses, IP addresses, card and phone numbers are searched as they are defined.  They are
the seeds of a bootstrapped extraction:

1. Every seed, and every other token with a digit or an at sign, is an *instance*; the word and
   the two words before it are *patterns*.  Patterns and instances form a graph.
2. A pattern's confidence in a kind is the sum of its instances' confidences over their number plus
   one; it needs ``LEAST_SEEDS`` different instances that are seeds or were found by the rounds
   before.  An instance takes the best confidence of its patterns; from ``LEAST_CONFIDENCE`` on it
   counts in the next of ``ROUNDS`` rounds, for patterns without seeds as well.
3. Tokens whose instance ends above ``LEAST_CONFIDENCE`` are added as ``like_<kind>``, e.g. a phone
   number without its plus that follows "call me at" as others do.

Only DataFrame functions are used.  The graph is kept as edges in the shared folder; each round is
two sums with partial aggregation and two joins, so a word before very many numbers is an ordinary
key.  Texts are read once.

Null and empty texts have no spans; documents are told apart by id and text, so null or repeated ids
give rows like any other, and rows that agree in both have the same spans.  An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duesmith.llm.common import id_and_text, read_table
from duesmith.sources.workspace import stored

KINDS = ("email", "ip", "card", "phone")
#: Possessive groups keep the matcher from recursing on very long runs; they match the same.
PATTERNS = {
    # A run that fails from its first character fails from all others, which are not tried; a match
    # may begin within a run only where the one before has ended.
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Shorter runs of digits would be dropped anyway.
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a search to be worth while.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Characters before a seed among which its context, its last one or two words, is looked for; of a
#: word that begins further back only what lies within them counts.
LOOK_BACK = 80
#: Elements of an array that are handled together.
BLOCK = 256
LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.7
ROUNDS = 3
#: A span, with the characters before it that may be its context.
SPAN = "struct<start: int, end: int, value: string, before: string>"


def _blocks(items: Column) -> Column:
    """A non-empty array in parts of ``BLOCK``: what grows element by element is only ever as long as one."""
    first = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    return F.transform(first, lambda n: F.slice(items, n * BLOCK + 1, F.lit(BLOCK)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    """Start, end (in code points) and value of every match, from left to right."""
    none = F.array().cast(f"array<{SPAN}>")

    def put(done: Column, x: Column) -> Column:
        begin = done["at"] + x["gap"]
        end = begin + x["size"]
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"), x["before"].alias("before"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    def placed(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("out")), put)["out"]

    def placed_in_blocks(blocks: Column) -> Column:
        totals = F.transform(
            blocks, lambda block: F.aggregate(block, F.lit(0), lambda done, x: done + x["gap"] + x["size"])
        )
        begins = F.aggregate(
            totals, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
        )
        return F.flatten(F.zip_with(blocks, F.slice(begins, F.lit(1), F.size(blocks)), placed))

    def sized(found: Column) -> Column:
        def one(gaps: Column, value: Column, i: Column) -> Column:
            # Two matches further back are two words at least.
            before = F.concat_ws("", F.get(found, i - 2), F.get(gaps, i - 1), F.get(found, i - 1), F.get(gaps, i))
            return F.struct(
                F.length(F.get(gaps, i)).alias("gap"),
                F.length(value).alias("size"),
                value.alias("value"),
                F.right(before, F.lit(LOOK_BACK)).alias("before"),
            )

        return _let(
            F.split(text, pattern, -1), lambda gaps: F.transform(found, lambda value, i: one(gaps, value, i))
        )

    def all_placed(sizes: Column) -> Column:
        few = F.when(F.size(sizes) <= BLOCK, placed(sizes, F.lit(0)))
        return few.otherwise(_let(_blocks(sizes), placed_in_blocks))

    def found_placed(found: Column) -> Column:
        return F.when(F.size(found) == 0, none).otherwise(_let(sized(found), all_placed))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found_placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether 13 to 19 digits pass the checksum."""
    digits = F.reverse(_digits(value))

    def worth(i: Column) -> Column:
        digit = F.substring(digits, i, 1).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda done, i: done + worth(i))
    return F.length(digits).between(13, 19) & (total % 10 == 0)


def _parts_fit(value: Column) -> Column:
    def fits(part: Column) -> Column:
        short = F.ltrim(part, F.lit("0"))
        number = F.concat(F.lit("0"), F.left(short, F.lit(3))).cast("int")
        return (F.length(short) <= 3) & (number <= 255)

    return F.forall(F.split(value, r"\."), fits)


VALID = {
    "email": lambda value: F.lit(True),
    "ip": _parts_fit,
    "card": _luhn,
    "phone": lambda value: F.length(_digits(value)).between(9, 15),
}


def base_spans(text: Column, kind: str) -> Column:
    """The valid matches of one kind; failing matches are dropped without another try."""
    none = F.array().cast(f"array<{SPAN}>")
    worth = F.contains(text, F.lit(NEEDED[kind])) if NEEDED[kind] else F.lit(True)
    if kind != "email":
        worth = worth & text.rlike("[0-9]")
    return F.when(worth, F.filter(_matches(text, PATTERNS[kind]), lambda s: VALID[kind](s["value"]))).otherwise(none)


def _contexts(before: Column) -> Column:
    """The last word and the last two words, in lower case, without outer punctuation."""
    words = F.filter(
        F.transform(
            F.split(F.lower(before), r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
        ),
        lambda w: w != "",
    )
    n = F.size(words)
    one = F.when(n > 0, F.concat(F.lit("1 "), F.get(words, n - 1)))
    two = F.when(n > 1, F.concat_ws(" ", F.lit("2"), F.get(words, n - 2), F.get(words, n - 1)))
    return F.array_compact(F.array(one, two))


def _bare(value: Column) -> Column:
    """A token without quotes, brackets and full stops around it."""
    ends = r"^[^\p{L}\p{N}+@]++|(?:(?<=[\p{L}\p{N}])|^)[^\p{L}\p{N}]++$"
    # What stands in front of a value may be all that there is: then the rest ends it.
    return F.regexp_replace(F.regexp_replace(value, ends, ""), ends, "")


def _tokens(text: Column, bases: Column) -> Column:
    """Other tokens with a digit or an at sign, cut to their bare form."""
    none = F.array().cast(f"array<{SPAN}>")

    def bare(s: Column) -> Column:
        def cut(value: Column) -> Column:
            begin = (s["start"] + F.instr(s["value"], value) - 1).cast("int")
            end = (begin + F.length(value)).cast("int")
            return F.struct(begin.alias("start"), end.alias("end"), value.alias("value"), s["before"].alias("before"))

        return _let(_bare(s["value"]), cut)

    def meet(b: Column, s: Column) -> Column:
        return (b["start"] < s["end"]) & (s["start"] < b["end"])

    def free(block: Column) -> Column:
        """Those that touch no base span; spans are first reduced to those around the block."""
        around = F.struct(F.get(block, F.lit(0))["start"].alias("start"), F.element_at(block, -1)["end"].alias("end"))
        near = _let(around, lambda x: F.filter(bases, lambda b: meet(b, x)))
        return _let(near, lambda some: F.filter(block, lambda s: ~F.exists(some, lambda b: meet(b, s))))

    found = F.filter(F.transform(_matches(text, TOKEN), bare), lambda s: F.length(s["value"]) >= 4)
    kept = _let(found, lambda s: F.when(F.size(s) > 0, F.flatten(F.transform(_blocks(s), free))).otherwise(none))
    return F.when(text.rlike("[0-9@]"), kept).otherwise(none)


def _scores(edges: DataFrame) -> DataFrame:
    """``value, kind, confidence`` of the instances that high-confidence patterns lead to."""
    seeds = edges.where(F.col("kind").isNotNull()).select("value", "kind").distinct().withColumn("confidence", F.lit(1.0))
    pairs = stored(edges.select("pattern", "value").distinct(), "pattern-instances")
    sizes = pairs.groupBy("pattern").agg(F.count("*").alias("size"))
    # Patterns of fewer instances can never have enough believed ones.
    sizes = stored(sizes.where(F.col("size") >= LEAST_SEEDS), "pattern-sizes")
    pairs = stored(pairs.join(sizes, "pattern", "left_semi"), "pattern-instances")
    believed = stored(seeds, "instances")
    for _ in range(ROUNDS):
        patterns = (
            pairs.join(believed, "value")
            .groupBy("pattern", "kind")
            .agg(F.sum("confidence").alias("weight"), F.count("*").alias("support"))
            .where(F.col("support") >= LEAST_SEEDS)
            .join(sizes, "pattern")
            .select("pattern", "kind", (F.col("weight") / (F.col("size") + 1)).alias("confidence"))
            .where(F.col("confidence") >= LEAST_CONFIDENCE)
        )
        reached = pairs.join(patterns, "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("confidence"))
        believed = stored(
            seeds.unionByName(reached).groupBy("value", "kind").agg(F.max("confidence").alias("confidence")), "instances"
        )
    return believed


def personal_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, the spans of each fixed form, and ``added`` (kind, start, end, value), of every document."""
    text = F.col("text")
    bases = [base_spans(text, kind).alias(kind) for kind in KINDS]
    keyed = id_and_text(docs).withColumn("row_key", F.xxhash64("doc_id", "text"))
    searched = keyed.select("doc_id", "row_key", "text", *bases)

    def with_context(kind: str | None, spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                F.lit(kind).cast("string").alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.lower(s["value"]).alias("value"),
                _contexts(s["before"]).alias("patterns"),
            ),
        )

    others = _tokens(text, F.concat(*map(F.col, KINDS)))
    instances = F.concat(*[with_context(kind, F.col(kind)) for kind in KINDS], with_context(None, others))
    # The four columns must be there before the tokens between them can be told.
    told = [F.transform(kind, lambda s: s.dropFields("before")).alias(kind) for kind in KINDS]
    searched = searched.withColumn("instances", instances).select("doc_id", "row_key", *told, "instances")
    searched = stored(searched, "personal-data")

    seen = searched.select("row_key", F.explode("instances").alias("i")).select("row_key", "i.*")
    edges = seen.select(F.explode("patterns").alias("pattern"), "value", "kind")
    scored = _scores(edges)
    best = scored.groupBy("value").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("like"))
    added = (
        seen.where(F.col("kind").isNull())
        .join(best, "value")
        .groupBy("row_key")
        .agg(
            F.array_sort(
                F.collect_set(F.struct(F.concat(F.lit("like_"), "like").alias("kind"), "start", "end", "value"))
            ).alias("added")
        )
    )
    none = F.array().cast("array<struct<kind: string, start: int, end: int, value: string>>")
    return searched.join(added, "row_key", "left").select("doc_id", *KINDS, F.coalesce("added", none).alias("added"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    def told(kind: Column, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string")))

    base = F.concat(*[told(F.lit(kind), F.col(kind)) for kind in KINDS])
    added = F.transform(
        F.col("added"), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return personal_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, added), ",").alias("spans"),
    )
