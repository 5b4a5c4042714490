"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows each partition sends to each shard is drawn first: such counts are
hypergeometric, so they are drawn without looking at a row, given only the
partitions' row counts and the shards' sizes. Then each partition permutes its
rows and deals them by its counts, the rows are exchanged once, and each shard
permutes what came in. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perennial.llm import names
from perennial.session import stage

SHARDS = 24
SEED = 42
# Partitions whose counts are drawn in one row; groups of them are drawn first.
FAN_OUT = 256
# Rows permuted together after the exchange, about.
CELL_ROWS = 1 << 14
# A draw looks so many standard deviations to either side of its mode; beyond, doubles add nothing.
REACH = 12
_LOCAL_BITS = 33


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def hypergeometric(good: Column, bad: Column, n: Column, u: Column) -> Column:
    """The count of good ones among ``n`` drawn of ``good + bad``, for a uniform ``u``.

    By inversion: the probabilities follow from each other, so they are summed
    upward and downward from the most likely count, once for their total and
    once until they pass the share ``u`` of it.
    """
    long = lambda x: x.cast("long")
    double = lambda x: x.cast("double")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    mean = double(n) * double(good) / F.greatest(double(good + bad), F.lit(1.0))
    deviation = F.sqrt(mean * double(bad) / F.greatest(double(good + bad), F.lit(1.0)))
    given = F.struct(
        good.alias("good"),
        bad.alias("bad"),
        n.alias("n"),
        u.alias("u"),
        F.greatest(zero, n - bad).alias("least"),
        F.least(n, good).alias("most"),
        long(F.floor((double(n) + 1) * (double(good) + 1) / (double(good + bad) + 2))).alias("mode"),
        (long(F.ceil(deviation * REACH)) + 30).alias("reach"),
    )

    def drawn(g: Column) -> Column:
        mode = F.greatest(g["least"], F.least(g["most"], g["mode"]))

        def counts(upward: bool) -> Column:
            end = F.least(g["most"], mode + g["reach"]) if upward else F.greatest(g["least"], mode - g["reach"])
            some = end > mode if upward else end < mode
            step = one if upward else -one
            return F.when(some, F.sequence(mode + step, end, step)).otherwise(F.array().cast("array<bigint>"))

        def ratio(k: Column, upward: bool) -> Column:
            """The probability of ``k`` by that of the count before it on the way from the mode."""
            low = k if upward else k + 1  # the upper one of both counts
            over = double(g["good"] - low + 1) * double(g["n"] - low + 1)
            under = double(low) * double(g["bad"] - g["n"] + low)
            return over / under if upward else under / over

        def summed(upward: bool) -> Column:
            start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"))
            return F.aggregate(
                counts(upward),
                start,
                lambda acc, k: _let(
                    acc["p"] * ratio(k, upward), lambda p: F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"))
                ),
                lambda acc: acc["sum"],
            )

        def passed(upward: bool, goal: Column) -> Column:
            """The first count at which the sum passes the goal; the last one if rounding keeps it below."""
            start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), mode.alias("at"))
            return F.aggregate(
                counts(upward),
                start,
                lambda acc, k: _let(
                    acc["p"] * ratio(k, upward),
                    lambda p: F.struct(
                        p.alias("p"),
                        (acc["sum"] + p).alias("sum"),
                        F.when(acc["sum"] <= goal, k).otherwise(acc["at"]).alias("at"),
                    ),
                ),
                lambda acc: acc["at"],
            )

        def picked(s: Column) -> Column:
            goal = g["u"] * (F.lit(1.0) + s["up"] + s["down"])
            return (
                F.when(goal < 1.0, mode)
                .when(goal < 1.0 + s["up"], passed(True, goal - 1.0))
                .otherwise(passed(False, goal - 1.0 - s["up"]))
            )

        return _let(F.struct(summed(True).alias("up"), summed(False).alias("down")), picked)

    return _let(given, drawn)


def deal(counts: Column, room: Column, salt: Sequence[Column], seed: int = SEED) -> Column:
    """For each source in ``counts`` how many rows it sends to each target, as arrays.

    ``room`` is what each target takes; its sum is that of ``counts``. A source
    draws from what the sources before it have left, target by target.
    """
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + x)
    empty = F.array().cast("array<bigint>")

    def one(n: Column, source: Column, left: Column) -> Column:
        start = F.struct(n.alias("n"), total(left).alias("pool"), empty.alias("sent"))

        def target(acc: Column, place: Column) -> Column:
            room_here = F.get(left, place)
            u = _uniform(F.lit(seed), *salt, source, place)
            drawn = hypergeometric(room_here, acc["pool"] - room_here, acc["n"], u)
            return _let(
                drawn,
                lambda x: F.struct(
                    (acc["n"] - x).alias("n"), (acc["pool"] - room_here).alias("pool"), F.array_append(acc["sent"], x).alias("sent")
                ),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(left) - 1), start, target, lambda acc: acc["sent"])

    begin = F.struct(room.alias("left"), F.array().cast("array<array<bigint>>").alias("rows"))

    def source(acc: Column, place: Column) -> Column:
        return _let(
            one(F.get(counts, place), place, acc["left"]),
            lambda sent: F.struct(
                F.zip_with(acc["left"], sent, lambda a, b: a - b).alias("left"), F.array_append(acc["rows"], sent).alias("rows")
            ),
        )

    places = F.when(F.size(counts) > 0, F.sequence(F.lit(0), F.size(counts) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, begin, source, lambda acc: acc["rows"])


def communication_matrix(counts: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``source, sent``: for each partition of ``(source, n)`` its row counts by shard.

    The shards' sizes are at most one apart and are met exactly. Groups of
    ``FAN_OUT`` partitions draw first, in one row of one number a group; the
    partitions of a group then draw from the group's counts, group by group.
    """
    pair = F.struct("source", "n")
    groups = counts.groupBy(F.expr(f"source div {FAN_OUT}").alias("group")).agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(pair)).alias("members")
    )
    whole = groups.select("group", "n").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.sort_array(F.collect_list(F.struct("group", "n"))).alias("groups")
    )
    room = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda s: F.expr(f"total div {n_shards}") + F.when(s < F.col("total") % n_shards, 1).otherwise(0),
    )
    first = whole.select("groups", deal(F.col("groups.n"), room, [F.lit("groups")], seed).alias("rooms"))
    by_group = first.select(F.explode(F.arrays_zip("groups", "rooms")).alias("x")).select(
        F.col("x.groups.group").alias("group"), F.col("x.rooms").alias("room")
    )
    dealt = groups.select("group", "members").join(by_group, "group").select(
        "members", deal(F.col("members.n"), F.col("room"), [F.lit("sources"), F.col("group")], seed).alias("rows")
    )
    return dealt.select(F.explode(F.arrays_zip("members", "rows")).alias("x")).select(
        F.col("x.members.source").alias("source"), F.col("x.rows").alias("sent")
    )


def shuffle(docs: DataFrame, keys: Sequence[str], n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` (from 0; row counts at most one apart) and ``slot`` (from 0, gapless in a shard).

    Every row gets a place, whatever it holds; null and repeated keys are keys
    like others, and rows alike in all keys are placed in any order. Columns
    named ``shard`` or ``slot`` in any case are replaced, the others stay. An
    empty table stays empty. With fewer rows than shards the last ones are empty.

    The rows are stored once in their partitions' random order, since that
    order may not be made again another way after a task is lost; they cross
    the network once, to cells of about ``CELL_ROWS`` rows of one shard. A hot
    source does not matter: rows are dealt whatever they hold. Random are the
    counts, and the orders by seeded hashes of the keys.
    """
    spark = docs.sparkSession
    own = names.without(docs, ("shard", "slot"))
    fresh = names.fresh([*own.columns, "shard", "slot"])
    order, local, source, after, cell, sent, base = (next(fresh) for _ in range(7))
    spread = F.col(order), *[F.col(f"`{k}`") for k in keys]
    permuted = (
        own.withColumn(order, F.xxhash64(F.lit(seed), F.lit("before"), *keys))
        .sortWithinPartitions(*spread)
        .withColumn(local, F.monotonically_increasing_id())
        .withColumn(source, F.shiftright(local, _LOCAL_BITS))
        .withColumn(local, F.col(local).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop(order)
    )
    stored = stage(permuted, "permuted-rows")
    counts = stored.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    matrix = stage(communication_matrix(stage(counts, "partition-counts"), n_shards, seed), "communication-matrix")
    ends = F.transform("sent", lambda x, i: F.aggregate(F.slice("sent", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, b: a + b))
    dealt = stored.join(matrix.select(F.col("source").alias(source), ends.alias(sent)), source).withColumn(
        "shard", F.size(F.filter(sent, lambda end: end <= F.col(local))).cast("int")
    )
    n_rows = stored.count()
    cells = max(1, -(-n_rows // (n_shards * CELL_ROWS)))
    placed = dealt.withColumn(after, F.xxhash64(F.lit(seed), F.lit("after"), *keys)).withColumn(
        cell, F.pmod(F.col(after), F.lit(cells)).cast("int")
    )
    sizes = placed.groupBy("shard", cell).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = stage(sizes.select("shard", cell, (F.sum("n").over(before) - F.col("n")).alias(base)), "cell-offsets")
    inside = Window.partitionBy("shard", cell).orderBy(after, *keys)
    exchanged = placed.withColumn("slot", F.row_number().over(inside).cast("long") - 1)
    return (
        exchanged.join(offsets, ["shard", cell])
        .withColumn("slot", F.col("slot") + F.col(base))
        .select(*[F.col(f"`{c}`") for c in own.columns], "shard", "slot")
    )


def write(sharded: DataFrame, path: str) -> None:
    """Write shards to folders ``shard=0`` and so on, rows in the order of their slots."""
    ranged = sharded.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)
