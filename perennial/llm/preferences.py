"""Preference formatting: one prompt of the common turns, two masked completions.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The chat format: what stands before and after each turn's text. {role} is the turn's role.
OPENING = "<|{role}|>\n"
CLOSING = "\n<|end|>\n"
TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame, key: list[str]) -> DataFrame:
    """``turns`` column: each conversation's turns in order, as ``(turn, role, text)``.

    Turns of one number come in order of role and text; repeated rows stay
    repeated turns. Null roles and texts become empty ones, a null number
    comes first. A conversation is one row, so its turns meet in one task.
    """
    one = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return turns.groupBy(*key).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def swapped_answers(turns: DataFrame, id_col: str = "conv_id", unpaired: bool = True) -> DataFrame:
    """Pairs from single conversations: the rejected side ends with the answer of a neighbour.

    The last trained turn of a conversation is replaced by that of its
    neighbour, the conversation with the other parity of the same half id.
    Conversations without an answer give no pair. Where the neighbour has none
    or is missing, or the id is, the rejected side ends before the answer, so
    its completion is empty; without ``unpaired`` such conversations give no
    pair. The turns without an id are one conversation. Repeated turns stay.
    One row per conversation: ``(pair_id, chosen, rejected)``; other columns
    of the turns play no part.
    """
    whole = conversations(turns.select(F.col(id_col).alias("pair_id"), "turn", "role", "text"), ["pair_id"])
    place = F.array_position(F.reverse(F.transform("turns", lambda t: t["role"] == TRAINED_ROLE)), True)
    identified = whole if unpaired else whole.where("pair_id is not null")
    placed = identified.withColumn("last", (F.size("turns") - place).cast("int")).where(place > 0)
    answers = placed.where("pair_id is not null").select(
        F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.get("turns", F.col("last"))["text"].alias("other")
    )
    replaced = F.transform(
        "turns", lambda t, i: F.when(i == F.col("last"), t.withField("text", F.col("other"))).otherwise(t)
    )
    if unpaired:
        replaced = F.when(F.col("other").isNull(), F.slice("turns", F.lit(1), F.col("last"))).otherwise(replaced)
    return placed.join(answers, "pair_id", "left" if unpaired else "inner").select(
        "pair_id", F.col("turns").alias("chosen"), replaced.alias("rejected")
    )


def sides(turns: DataFrame, pair_col: str = "pair_id", side_col: str = "side") -> DataFrame:
    """Pairs from turns marked ``chosen`` or ``rejected``; a missing side has no turns."""
    whole = conversations(turns.where(F.col(side_col).isin("chosen", "rejected")), [pair_col, side_col])
    of = lambda side: F.first(F.when(F.col(side_col) == side, F.col("turns")), ignorenulls=True)
    none = F.expr("cast(array() as array<struct<turn:bigint,role:string,text:string>>)")
    kind = dict(whole.dtypes)["turns"]
    return whole.groupBy(F.col(pair_col).alias("pair_id")).agg(
        F.coalesce(of("chosen"), none.cast(kind)).alias("chosen"), F.coalesce(of("rejected"), none.cast(kind)).alias("rejected")
    )


def _opening(turn: Column) -> Column:
    before, after = OPENING.split("{role}")
    return F.concat(F.lit(before), turn["role"], F.lit(after))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_opening(t), t["text"], F.lit(CLOSING))), "")


def _mask(turns: Column) -> Column:
    """Lengths in characters that are masked and trained in turn, beginning with masked.

    Trained are a trained turn's text and its closing; openings and the turns
    of other roles are masked. Each turn gives two lengths, the second may be 0.
    """
    closing = F.lit(len(CLOSING))
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.when(
                t["role"] == TRAINED_ROLE,
                F.array(F.char_length(_opening(t)), F.char_length(t["text"]) + closing),
            ).otherwise(F.array(F.char_length(_opening(t)) + F.char_length(t["text"]) + closing, F.lit(0))),
        )
    )


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Render ``(pair_id, chosen, rejected)`` as prompt and paired completions.

    The prompt is the longest run of turns both sides begin with, compared by
    role and text, rendered once. It ends before the first differing turn; with
    equal sides it is everything and both completions are empty. Each
    completion comes with its mask: lengths in characters, masked and trained
    in turn. ``differs`` tells whether there is anything to prefer.
    """
    same = F.zip_with(
        "chosen",
        "rejected",
        lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)),
    )
    first = F.array_position(same, False)
    common = F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")
    cut = pairs.withColumn("n_prompt_turns", common)
    rest = lambda side: F.slice(side, F.col("n_prompt_turns") + 1, F.size(side) + 1)
    parted = cut.select(
        "pair_id",
        "n_prompt_turns",
        F.slice("chosen", F.lit(1), F.col("n_prompt_turns")).alias("p"),
        rest("chosen").alias("c"),
        rest("rejected").alias("r"),
    )
    return parted.select(
        "pair_id",
        "n_prompt_turns",
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _mask(F.col("c")).alias("chosen_mask"),
        _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("r")).alias("rejected_mask"),
        ((F.size("c") > 0) | (F.size("r") > 0)).alias("differs"),
    )
