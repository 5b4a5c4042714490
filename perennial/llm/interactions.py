"""Filter interaction audit by failing-id relations.

Each filter is judged once for each document and leaves a table of the ids that
fail it. What a filter does after others is then a matter of joins on ids:
survivors of a set of filters are what left-anti joins with their tables leave,
removals are the survivors that a left-semi join finds in the next table, and
redundancies are the failing ids that an anti join with the survivors leaves.
Texts are read once; all later joins are on narrow rows in buckets of the id,
where they need no shuffle. The orders of the filters only look up counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.session import stage
from perennial.sources import buckets

WORD = r"[^\x20\x09-\x0D]+"

# Failure conditions over the measurements of a text. A filter has a name of one letter.
FILTERS: dict[str, str] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_chars",
    "D": "n_marks > 0",
    "E": "is_copy",
}
# All orders are reported: n! of them, over 2^n sets of filters.
MOST_FILTERS = 6


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One narrow row for each document: ``row, id, part`` and the measurements of its text.

    ``row`` numbers the rows, so that repeated or missing ids stay rows of their
    own; it is only lasting once the result is stored. A null text counts as
    empty, a null part as the empty string; an empty text has no words and no
    characters. ``text_key`` is the SHA-256 of the text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        body.alias("body"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
    )
    return words.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "part",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.char_length("body").cast("long").alias("n_chars"),
        F.regexp_count("body", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count("body", F.lit("[#$%&*|]")).cast("long").alias("n_marks"),
        F.unhex(F.sha2("body", 256)).alias("text_key"),
    )


def with_copies(measured: DataFrame) -> DataFrame:
    """Add ``is_copy``: the text is that of a smaller id anywhere in the table.

    A null id is neither smaller nor larger than another. Only the keys that
    several rows share, and their smallest ids, meet the rows again; that table
    is stored, so its size decides between a broadcast and a shuffle, where
    adaptive execution splits the key of a large group.
    """
    shared = stage(
        measured.groupBy("text_key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "shared-texts",
    )
    joined = measured.join(shared, "text_key", "left")
    return joined.withColumn("is_copy", F.coalesce(F.col("id") > F.col("first"), F.lit(False))).drop("first")


def failing_ids(judged: DataFrame, filters: dict[str, str] = FILTERS) -> DataFrame:
    """The failing-id relations as one table ``filter, bit, row, id, part``, a row for each filter a document fails."""
    failed = [
        F.when(F.expr(condition), F.struct(F.lit(name).alias("filter"), F.lit(1 << number).alias("bit")))
        for number, (name, condition) in enumerate(filters.items())
    ]
    return judged.select(F.inline(F.array_compact(F.array(*failed))), "row", "id", "part")


def _labelled(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``good`` and ``toxic``: whether any label of the row's id says so."""
    said = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    flag = lambda name: F.coalesce(name, F.lit(False)).cast("long").alias(name)
    return rows.join(said, "id", "left").select("row", "part", flag("good"), flag("toxic"))


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: dict[str, str] = FILTERS,
    id_col: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """What each filter does at each place of each order of the filters, by part.

    One row, zeros included, for each value of ``part``, ``filter_order`` (all
    of them, applied left to right) and ``step`` (from 1; its filter is that
    letter): documents ``kept`` after the step, ``removed`` at it, ``redundant``
    (failing its filter but removed before), ``unique_fails`` (failing its
    filter only), ``good_lost`` and ``toxic_lost`` (removed here with quality 1
    or toxic 1 in ``labels``) and ``shapley`` (its filter's removals summed
    over all orders).

    Rows count, not ids: repeated rows count each, and a null id is a document
    that is no copy and has no label. A label table with several rows for an id
    labels it good or toxic if any of them does; null labels say nothing. Null
    and empty texts are measured alike. Without documents there are no rows.
    Other columns of the tables play no part, whatever their names.

    For n filters there are 2^n sets of filters, so at most 2^n narrow rows for
    each document are stored, and fewer the more filters it fails.
    """
    letters = list(filters)
    if len(letters) > MOST_FILTERS or any(len(name) != 1 for name in letters):
        raise ValueError(f"at most {MOST_FILTERS} filters, named by one letter each")
    spark = docs.sparkSession
    judged = stage(with_copies(stage(measure(docs, id_col, text, part), "measured-texts")), "judged-texts")
    base = buckets.store(_labelled(judged, labels, id_col), "audited", ["row"])
    failing = buckets.store(failing_ids(judged, filters), "failing", ["row"])
    surviving = buckets.store(_survivors(spark.table(base), spark.table(failing), letters), "survivors", ["row"])
    counts = stage(_counts(spark.table(surviving), spark.table(failing), letters), "audit-counts")
    buckets.drop(spark, base, failing, surviving)
    return _report(counts, letters)


def _survivors(base: DataFrame, failing: DataFrame, letters: list[str]) -> DataFrame:
    """For each set of filters the rows that none of them removes: ``row, part, good, toxic, past``.

    ``past`` numbers the set. Filter by filter every row goes on twice, without
    the filter and with it; an anti join with the filter's failing ids then
    takes out the second where it fails.
    """
    rows = base.withColumn("past", F.lit(0))
    for number, name in enumerate(letters):
        bit = F.lit(1 << number)
        both = rows.withColumn("past", F.explode(F.array(F.col("past"), F.col("past").bitwiseOR(bit))))
        ids = failing.where(F.col("filter") == name).select(F.col("row").alias("failing_row"))
        fails = (F.col("row") == F.col("failing_row")) & (F.col("past").bitwiseAND(bit) != 0)
        rows = both.join(ids.hint("merge"), fails, "left_anti")
    return rows


def _counts(surviving: DataFrame, failing: DataFrame, letters: list[str]) -> DataFrame:
    """Per part, set of filters and next filter: survivors, removals with labels, redundancies.

    ``what, part, past, bit, n, good, toxic``; the filter's bit is null for
    survivors. The joins' only key is the row, by which both sides are stored,
    so nothing moves; which filter or set is meant is a condition beside it.
    """
    sums = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    kind = lambda name: F.lit(name).alias("what")
    bits = F.array(*[F.lit(1 << number) for number in range(len(letters))])
    ids = failing.select(F.col("row").alias("failing_row"), F.col("bit").alias("failing_bit")).hint("merge")
    same_row = F.col("row") == F.col("failing_row")
    kept = surviving.groupBy(kind("kept"), "part", "past", F.lit(None).cast("int").alias("bit")).agg(*sums)
    nexts = F.filter(bits, lambda bit: F.col("past").bitwiseAND(bit) == 0)
    judged_next = surviving.withColumn("bit", F.explode(nexts))
    fails = same_row & (F.col("bit").bitwiseAND(F.col("failing_bit")) != 0)
    removed = judged_next.join(ids, fails, "left_semi").groupBy(kind("removed"), "part", "past", "bit").agg(*sums)
    sets = F.filter(
        F.sequence(F.lit(0), F.lit((1 << len(letters)) - 1)), lambda past: past.bitwiseAND(F.col("bit")) == 0
    )
    before = failing.select("row", "part", "bit", F.explode(sets).alias("past"))
    survivors = surviving.select(F.col("row").alias("failing_row"), F.col("past").alias("survived")).hint("merge")
    still_there = same_row & (F.col("past").bitwiseXOR(F.col("survived")) == 0)
    gone = before.join(survivors, still_there, "left_anti")
    none = F.lit(0).cast("long")
    redundant = gone.groupBy(kind("redundant"), "part", "past", "bit").agg(
        sums[0], F.max(none).alias("good"), F.max(none).alias("toxic")
    )
    return kept.unionByName(removed).unionByName(redundant)


def _report(counts: DataFrame, letters: list[str]) -> DataFrame:
    """The counts looked up for every step of every order."""
    orders = F.array(*[F.lit("".join(order)) for order in permutations(letters)])
    bit = lambda name: F.expr(f"shiftleft(1, instr('{''.join(letters)}', {name}) - 1)")
    steps = (
        counts.select("part")
        .distinct()
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
        .withColumn("filter", F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))
        .withColumn(
            "past",
            F.expr(
                "aggregate(sequence(1, step), 0, (acc, i) -> if(i < step, acc | shiftleft(1, "
                f"instr('{''.join(letters)}', substring(filter_order, i, 1)) - 1), acc))"
            ),
        )
        .withColumn("bit", bit("filter"))
        .withColumn("then", F.col("past").bitwiseOR(F.col("bit")))
        .withColumn("others", F.lit((1 << len(letters)) - 1).bitwiseXOR(F.col("bit")))
    )
    of = lambda what: counts.where(F.col("what") == what)
    zero = lambda name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
    kept = of("kept").select("part", F.col("past").alias("then"), F.col("n").alias("kept"))
    removed = of("removed").select(
        "part", "past", "bit", F.col("n").alias("removed"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost")
    )
    redundant = of("redundant").select("part", "past", "bit", F.col("n").alias("redundant"))
    unique = of("removed").select("part", F.col("past").alias("others"), "bit", F.col("n").alias("unique_fails"))
    looked_up = (
        steps.join(kept, ["part", "then"], "left")
        .join(removed, ["part", "past", "bit"], "left")
        .join(redundant, ["part", "past", "bit"], "left")
        .join(unique, ["part", "others", "bit"], "left")
    )
    shares = looked_up.groupBy("part", "bit").agg(F.sum(F.coalesce("removed", F.lit(0))).alias("shapley"))
    return looked_up.join(shares, ["part", "bit"]).select(
        "part",
        "filter_order",
        "step",
        *[zero(n) for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")],
    )
