"""Quality rules as a ledger: every rule is judged once, policies are applied afterwards.

Only DataFrame functions are used and no row leaves its partition, so a hot
source or a very long text costs what its own words cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.llm import names

# White space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
POSITION_BITS = 31

# Rules in bit order. A rule is a condition over the measurements; its bit is set when the text fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "shouting": "4 * n_exclaims > n_words",
    "digits": "5 * n_digits > word_chars",
    "many_short_lines": "n_lines >= 10 and n_words < 3 * n_lines",
}
BASE_RULES = ("few_words", "repeated_words")

# Versioned policies: the rules that reject. A policy is a mask over the ledger, never a new scan.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}


def mask(rules: tuple[str, ...]) -> int:
    """The bits of some rules."""
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in set(rules))


def _packed(hashes: Column) -> Column:
    """Each window's 32 hash bits above its position, sorted as plain longs."""
    return F.sort_array(
        F.transform(
            hashes,
            lambda h, i: F.shiftleft(h.bitwiseAND(F.lit(0xFFFFFFFF)), POSITION_BITS).bitwiseOR(
                i.cast("long")
            ),
        )
    )


def _same_as_neighbour(items: Column, key) -> Column:
    """The elements of a sorted array whose key equals that of the element before or after."""
    return F.filter(
        items,
        lambda x, i: F.coalesce(key(F.get(items, i - 1)) == key(x), F.lit(False))
        | F.coalesce(key(F.get(items, i + 1)) == key(x), F.lit(False)),
    )


def _covered(starts: Column) -> Column:
    """Positions covered by windows of three that begin at the sorted starts."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
    return F.aggregate(
        starts,
        begin,
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements the rules need; other columns stay.

    Null and empty texts have no words and measure zero everywhere. Repeated
    rows are measured alike. Columns of ``docs`` that share a measurement's
    name are replaced. Work per text is n log n in its words: windows are
    sorted by 32 hash bits first, and only those that meet another one are
    compared by the full hash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    at = F.lit((1 << POSITION_BITS) - 1)
    internal = ("_words", "_lines", "_hashes", "_windows", "_packed", "_meeting")
    own, back = names.aside(docs, internal)
    base = own.withColumns(
        {
            "_words": F.regexp_extract_all(body, F.lit(WORD), F.lit(0)),
            "_lines": F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD)),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOL)).cast("long"),
            "n_exclaims": F.regexp_count(body, F.lit("!")).cast("long"),
            "n_digits": F.regexp_count(body, F.lit("[0-9]")).cast("long"),
        }
    )
    counted = base.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    )
    windows = counted.withColumn(
        "_windows",
        F.when(
            F.size("_hashes") >= 3,
            F.transform(
                F.slice("_hashes", F.lit(1), F.size("_hashes") - 2),
                lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2)),
            ),
        ),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    packed = windows.withColumn("_packed", F.when(repeats, _packed(F.col("_windows"))))
    meeting = packed.withColumn(
        "_meeting",
        F.when(
            F.col("_packed").isNotNull(),
            F.sort_array(
                F.transform(
                    _same_as_neighbour(F.col("_packed"), lambda x: F.shiftright(x, POSITION_BITS)),
                    lambda x: F.struct(
                        F.get("_windows", x.bitwiseAND(at).cast("int")).alias("h"),
                        x.bitwiseAND(at).alias("p"),
                    ),
                )
            ),
        ),
    )
    starts = F.sort_array(
        F.transform(_same_as_neighbour(F.col("_meeting"), lambda x: x["h"]), lambda x: x["p"])
    )
    return meeting.withColumn(
        "n_repeat_words", F.coalesce(_covered(starts), F.lit(0)).cast("long")
    ).drop(*internal).withColumnsRenamed(back)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measurements and ``fail_bits``: one bit for each rule of ``RULES`` the text fails.

    The bits are tied to a row number that every row has. A filter on them
    therefore stays above the measurements; pushed below, it would repeat their
    expressions at every use, within loops over words too.
    """
    bits = F.lit(0).cast("long")
    for position, condition in enumerate(RULES.values()):
        bit = F.when(F.expr(condition), F.lit(1 << position)).otherwise(F.lit(0)).cast("long")
        bits = bits.bitwiseOR(bit)
    there = F.monotonically_increasing_id() >= 0
    return measure(docs, text).withColumn("fail_bits", F.when(there, bits))


def apply_policy(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Add ``base_failed`` and ``kept`` under a policy; the base rules always reject."""
    rejecting = mask(POLICIES[policy]) | mask(BASE_RULES)
    return rows.withColumns(
        {
            "base_failed": F.col("fail_bits").bitwiseAND(F.lit(mask(BASE_RULES))) != 0,
            "kept": F.col("fail_bits").bitwiseAND(F.lit(rejecting)) == 0,
        }
    )


def ablation(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """What each rule of a policy does: texts that fail it, that only it rejects, kept without it.

    Texts are counted per distinct bit mask first (2^rules rows at most), so
    the ledger is read once and never shuffled by text. Repeated rows count
    each; an empty ledger gives no rows; other columns play no part.
    """
    rejecting = mask(POLICIES[policy])
    masks = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(rejecting)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        masks.select(
            "bits",
            "n",
            F.explode(
                F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in POLICIES[policy]])
            ).alias("r"),
        )
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
            F.sum(
                F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)
            ).alias("n_kept_without"),
        )
    )
