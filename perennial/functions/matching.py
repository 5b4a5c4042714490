"""Fuzzy equality of class labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.functions.binding import let
from perennial.session import stage

# Label aliases of the base model.
ALIASES = {
    "Saint_Bernard": "stbernard",
    "german shepherd": "germanshepherd",
    "alaskan malamute": "malamute",
    "West_Highland_white_terrier": "terrier westhighland",
    "blldog boston": "Boston_bull",
    "terrier scottish": "Scotch_terrier",
    "hound blood": "bloodhound",
    "terrier kerryblue": "Kerry_blue_terrier",
}

# Share of common words and fuzzy ratio that count as a match, base version.
WORD_SHARE = 0.75
FUZZY_RATIO = 85
BASE_VERSION = "v3_0"

_BLANKS = " \t\n\r\x0b\x0c"


def _plain(label: Column) -> Column:
    return F.btrim(F.translate(F.lower(label), "_-", "  "), F.lit(_BLANKS))


def words(label: Column, alias_mode: str = "literal") -> Column:
    """Sorted distinct words of a label after alias lookup.

    ``literal`` looks aliases up exactly as spelled above, so keys with capitals
    or underscores never match and replacements keep their spelling.
    ``normalized`` spells keys and replacements like the labels they meet.
    """
    if alias_mode not in ("literal", "normalized"):
        raise ValueError(f"unknown alias mode {alias_mode!r}")
    spell = _plain if alias_mode == "normalized" else (lambda c: c)
    entries = [spell(F.lit(text)) for pair in ALIASES.items() for text in pair]
    plain = _plain(label)
    found = F.coalesce(F.try_element_at(F.create_map(*entries), plain), plain)
    return F.array_sort(F.array_distinct(F.array_remove(F.split(found, r"\s+"), "")))


# Characters in a word of bits: a bigint holds them and a carry and stays positive.
_WORD_BITS = 61


def _characters(text: Column) -> Column:
    return F.array_remove(F.split(text, ""), "")


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts of any length.

    One row of the usual table as the bits of a few numbers, updated once per
    character of ``a``: a zero bit marks a column where the row's value grows
    by one. Words of bits are updated from the low one up, the carry of their
    addition goes to the next.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def full(word: Column) -> Column:
        return F.call_function("shiftleft", one, F.size(word)) - 1

    def places(word: Column, ch: Column) -> Column:
        return F.aggregate(
            word, zero, lambda acc, c: F.shiftleft(acc, 1).bitwiseOR((c == ch).cast("bigint"))
        )

    def last_row(words: Column) -> Column:
        def next_row(row: Column, ch: Column) -> Column:
            start = F.struct(F.array().cast("array<bigint>").alias("row"), zero.alias("carry"))

            def next_word(acc: Column, item: Column) -> Column:
                old, word = item["old"], item["word"]
                return let(
                    old.bitwiseAND(places(word, ch)),
                    lambda kept: let(
                        old + kept + acc["carry"],
                        lambda total: F.struct(
                            F.concat(
                                acc["row"],
                                F.array(total.bitwiseAND(full(word)).bitwiseOR(old - kept)),
                            ).alias("row"),
                            F.call_function("shiftright", total, F.size(word)).alias("carry"),
                        ),
                    ),
                )

            paired = F.zip_with(
                row, words, lambda old, word: F.struct(old.alias("old"), word.alias("word"))
            )
            return F.aggregate(paired, start, next_word, lambda acc: acc["row"])

        return F.aggregate(_characters(a), F.transform(words, full), next_row)

    def backwards(characters: Column) -> Column:
        """Words of up to 61 characters, each reversed: its first character is the low bit."""
        starts = F.sequence(F.lit(1), F.greatest(F.size(characters), F.lit(1)), F.lit(_WORD_BITS))
        return F.transform(starts, lambda s: F.reverse(F.slice(characters, s, _WORD_BITS)))

    ones = F.aggregate(
        let(let(_characters(b), backwards), last_row),
        F.lit(0),
        lambda acc, word: acc + F.bit_count(word),
    )
    return F.length(b) - ones


def _characters(text: Column) -> Column:
    return F.array_remove(F.split(text, ""), "")


def fuzzy_ratio(a: Column, b: Column) -> Column:
    """Similarity 0..100 where a substitution costs two edits; null counts as 0."""
    total = F.length(a) + F.length(b)
    ratio = F.bround(F.lit(200.0) * common_subsequence(a, b) / total, 0).cast("int")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(0))
        .when(a == b, F.lit(100))
        .otherwise(ratio)
    )


def tuned_match(actual: Column, predicted: Column) -> Column:
    """Rule of the fine-tuned versions: plain equality, two nulls are equal."""
    return actual.eqNullSafe(predicted)


def base_match(actual: Column, predicted: Column, alias_mode: str = "literal") -> Column:
    """Rule of the base version: word sets first, spelling last. Null stays null."""
    return _base_ladder(
        actual, predicted, words(actual, alias_mode), words(predicted, alias_mode)
    )


def _base_ladder(actual: Column, predicted: Column, a: Column, p: Column) -> Column:
    shared = F.size(F.array_intersect(a, p))
    near = (shared >= F.size(a) * F.lit(WORD_SHARE)) & (shared >= F.size(p) * F.lit(WORD_SHARE))
    inside = (shared == F.size(a)) | (shared == F.size(p))
    low_a, low_p = F.lower(actual), F.lower(predicted)
    return (
        F.when(actual.isNull() | predicted.isNull(), F.lit(None).cast("boolean"))
        .when(a == p, F.lit(True))
        .when((F.size(a) == 0) | (F.size(p) == 0), low_a == low_p)
        .when(near, F.lit(True))
        .when(inside, F.lit(True))
        .otherwise(fuzzy_ratio(low_a, low_p) >= FUZZY_RATIO)
    )


def with_matches(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Add ``base_match`` and ``tuned_match``.

    The base rule is costly per call and a log repeats the same few label pairs,
    so it runs once per distinct pair. The verdicts are staged: within the
    broadcast threshold rows look them up without being shuffled, beyond it the
    join is a shuffled one whose hot pairs adaptive execution splits.
    """
    pairs = (
        df.select(F.col(actual).alias("a_"), F.col(predicted).alias("p_"))
        .filter(F.col("a_").isNotNull() & F.col("p_").isNotNull())
        .distinct()
    )
    split = pairs.withColumn("wa_", words(F.col("a_"))).withColumn("wp_", words(F.col("p_")))
    verdicts = stage(
        split.select(
            "a_",
            "p_",
            _base_ladder(F.col("a_"), F.col("p_"), F.col("wa_"), F.col("wp_")).alias("base_match"),
        ),
        "label-pairs",
    )
    same = (F.col(actual) == F.col("a_")) & (F.col(predicted) == F.col("p_"))
    return (
        df.join(verdicts, same, "left")
        .drop("a_", "p_")
        .withColumn("tuned_match", tuned_match(F.col(actual), F.col(predicted)))
    )


def is_match(version: Column) -> Column:
    """Pick the verdict that applies to a version, after :func:`with_matches`."""
    return F.when(version == BASE_VERSION, F.col("base_match")).otherwise(F.col("tuned_match"))
