"""Removal of long strings that occur twice: a suffix array of anchored suffixes.

Not every suffix is sorted. Of each 200-byte string the lowest hash among its
32-byte strings is the anchor; equal strings have equal anchors at equal
places, so only suffixes that begin at anchors which occur twice can matter.
They meet by their anchor, with up to 168 bytes before it and 200 from it:

1. anchors whose whole surroundings agree everywhere are settled by counting;
2. for the others one copy of each distinct surrounding is sorted, deep-shallow,
   to the right and to the left, and the common prefixes tell which strings
   around the anchor occur twice;
3. an anchor with very many distinct surroundings is not gathered: ranges of its
   strings are split by ever deeper prefixes and counted, two levels down to
   single strings.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm import arrow, hashing, names
from perennial.llm.cleanup import discard, stage_and_release
from perennial.llm.suffixes import common_prefix, deep_shallow_order

LENGTH = 200
ANCHOR = 32
# Distinct surroundings of one anchor that are sorted together by one task.
GATHERED = 256
# Ranges into which the places of a string around its anchor are split.
RANGES = 13

# Bytes of a batch, compressed texts often, that a task works on at once: what they unpack to is several times that.
SLICE = 1 << 20

_POSITION_BITS = 28
_PLACE = (1 << _POSITION_BITS) - 1


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: block-wise running minima from both sides."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, anchor: int, first=None, last=None):
    """Anchors of texts laid end to end: positions, hashes, hashes of surroundings, index of the text.

    Only strings that begin in ``[first, last)`` count; texts shorter than
    ``length`` have none.
    """
    empty = np.zeros(0, np.int64)
    lows = starts if first is None else np.maximum(starts, first)
    highs = ends - length + 1 if last is None else np.minimum(ends - length + 1, last)
    usable = highs > lows
    if not usable.any():
        return empty, empty, empty, empty
    ranges = hashing.RangeHash(data)
    hashes = ranges.every(anchor)
    places = np.arange(len(hashes), dtype=np.uint64)
    # the lowest hash, of equal ones the last: its place is in the low bits
    low = _window_minima((hashes & ~np.uint64(_PLACE)) | (np.uint64(_PLACE) - places), length - anchor + 1)
    chosen = np.zeros(len(low) + 1, np.int8)
    np.add.at(chosen, lows[usable], 1)
    np.add.at(chosen, highs[usable], -1)
    at = (np.uint64(_PLACE) - (low[np.cumsum(chosen[:-1]) > 0] & np.uint64(_PLACE))).astype(np.int64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    text = np.searchsorted(starts, at, "right") - 1
    left = np.maximum(starts[text], at - (length - anchor))
    right = np.minimum(ends[text], at + length)
    around = hashing.mixed(ranges.of(left, right) + (at - left).astype(np.uint64))
    return at, hashes[at].view(np.int64), around.view(np.int64), text


def _anchor_rows(length: int, anchor: int):
    def of_one(data: np.ndarray):
        """Anchors of a text longer than a chunk, piece by piece with what surrounds the piece."""
        out: dict[int, tuple[int, int]] = {}
        for first in range(0, len(data), hashing.CHUNK):
            begin, end = max(0, first - length), min(len(data), first + hashing.CHUNK + 2 * length)
            at, h, around, _ = anchors(
                data[begin:end], np.array([0]), np.array([end - begin]), length, anchor, first - begin, first - begin + hashing.CHUNK
            )
            out |= {int(p) + begin: (int(a), int(b)) for p, a, b in zip(at, h, around, strict=True)}
        return out

    def run(batch: pa.RecordBatch) -> dict | None:
        keys, texts = (batch.column(batch.schema.get_field_index(n)) for n in ("key", "text"))
        made: dict[str, list] = defaultdict(list)
        waiting: list[tuple[bytes, bytes]] = []

        def empty() -> None:
            if not waiting:
                return
            data = np.frombuffer(b"".join(t for _, t in waiting), np.uint8)
            ends = np.cumsum([len(t) for _, t in waiting])
            starts = np.concatenate([[0], ends[:-1]])
            at, h, around, text = anchors(data, starts, ends, length, anchor)
            made["h"].append(h)
            made["around"].append(around)
            made["at"].append(at - starts[text])
            made["key"].append(pa.array([k for k, _ in waiting], pa.binary()).take(pa.array(text)))
            waiting.clear()

        held = 0
        for key, text in zip(keys.to_pylist(), texts.to_pylist(), strict=True):
            raw = text.encode("utf-8") if text else b""
            if len(raw) < length:
                continue
            if len(raw) > hashing.CHUNK:
                found = of_one(np.frombuffer(raw, np.uint8))
                made["at"].append(np.array(list(found)))
                made["h"].append(np.array([v[0] for v in found.values()]))
                made["around"].append(np.array([v[1] for v in found.values()]))
                made["key"].append(pa.array([key] * len(found), pa.binary()))
                continue
            if held + len(raw) > hashing.CHUNK:
                empty()
                held = 0
            waiting.append((key, raw))
            held += len(raw)
        empty()
        if not made:
            return None
        return {n: pa.array(np.concatenate(made[n])) for n in ("h", "around", "at")} | {"key": pa.concat_arrays(made["key"])}

    return run


_ANCHORS = T.StructType(
    [
        T.StructField("h", T.LongType()),
        T.StructField("around", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("key", T.BinaryType()),
    ]
)
_SURROUNDINGS = T.StructType(
    [
        T.StructField("h", T.LongType()),
        T.StructField("around", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("left", T.BinaryType()),
        T.StructField("right", T.BinaryType()),
    ]
)
_EXTENTS = T.StructType(
    [
        T.StructField("h", T.LongType()),
        T.StructField("around", T.LongType()),
        T.StructField("before", T.LongType()),
        T.StructField("after", T.LongType()),
    ]
)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Equal texts bear equal keys."""
    return docs.withColumn("key", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))


def _packed(keyed: DataFrame, text: str, drop: tuple[str, ...] = ()) -> DataFrame:
    def run(batch: pa.RecordBatch) -> list:
        press = zstandard.ZstdCompressor(level=3)
        values = batch.column(batch.schema.get_field_index(text)).to_pylist()
        return [[press.compress((v or "").encode("utf-8")) for v in values]]

    return arrow.append(keyed, run, [T.StructField("blob", T.BinaryType())], (text, *drop), SLICE)


def _surroundings(wanted: DataFrame, keyed: DataFrame, text: str, length: int, anchor: int) -> DataFrame:
    """The bytes around one occurrence of each distinct surrounding: before the anchor, reversed, and from it."""

    reach = length - anchor

    def run(batch: pa.RecordBatch) -> dict:
        unpack = zstandard.ZstdDecompressor()
        blobs, lists = (batch.column(batch.schema.get_field_index(n)) for n in ("blob", "places"))
        places, edges = lists.flatten(), np.cumsum([0, *lists.value_lengths().to_pylist()])
        ats = places.field("at").to_pylist()
        before, after = [], []
        for blob, first, last in zip(blobs.to_pylist(), edges, edges[1:], strict=False):
            data = unpack.decompress(blob)
            for at in ats[first:last]:
                before.append(data[max(0, at - reach) : at][::-1])
                after.append(data[at : at + length])
        return {n: places.field(n) for n in ("h", "around", "n")} | {"left": before, "right": after}

    long = keyed.where(F.octet_length(text) >= length).select("key", F.col(text).alias("text"))
    texts = _packed(long, "text").dropDuplicates(["key"])
    places = wanted.groupBy("key").agg(F.collect_list(F.struct("h", "around", "n", "at")).alias("places"))
    return arrow.flat_map(texts.join(places, "key").select("blob", "places"), run, _SURROUNDINGS, SLICE)


def extents(members: list[tuple[bytes, bytes]], length: int, anchor: int = 0) -> list[tuple[int, int] | None]:
    """How far around the anchor each member's repeated strings reach, before and after; None without any.

    A member is the reversed bytes before the anchor and those from it on. A
    string that begins ``d`` bytes before the anchor occurs in two members if
    they agree on ``d`` bytes to the left and ``length - d`` to the right.
    Sorting both sides makes members that agree on a depth neighbours, so for
    each ``d`` that can matter they are numbered by one pass over each order.
    All members agree on the anchor, so their right sides are sorted from behind it.
    """
    n = len(members)
    sides = []
    for side, agreed in ((0, 0), (1, anchor)):
        strings = [m[side] for m in members]
        order = deep_shallow_order(strings, agreed)
        shared = [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
        sides.append((order, shared))
    (left_order, left_shared), (right_order, right_shared) = sides
    if max(left_shared, default=0) + max(right_shared, default=0) < length:
        return [None] * n
    depths = {min(d, length) for d in left_shared} | {max(length - r, 0) for r in right_shared}
    reach: list[list[int] | None] = [None] * n
    number = [0] * n
    for d in sorted(depths):
        group = 0
        for member, shared in zip(left_order, [*left_shared, 0], strict=True):
            number[member] = group
            group += shared < d
        met: dict[tuple[int, int], list[int]] = defaultdict(list)
        group = 0
        for member, shared in zip(right_order, [*right_shared, 0], strict=True):
            left, right = members[member]
            if len(left) >= d and len(right) >= length - d:
                met[number[member], group].append(member)
            group += shared < length - d
        for same in met.values():
            if len(same) > 1:
                for member in same:
                    if reach[member] is None:
                        reach[member] = [d, d]
                    reach[member][1] = d
    # the string with the smallest d ends last, that with the largest begins first
    return [None if r is None else (r[1], length - r[0]) for r in reach]


def _sorted_extents(groups: DataFrame, length: int, anchor: int) -> DataFrame:
    """Extents within the gathered groups, which arrive one after the other."""

    def close(h: int, rows: list, made: dict) -> None:
        for (around, n, _, _), found in zip(rows, extents([(l, r) for _, _, l, r in rows], length, anchor), strict=True):
            if found and n == 1:
                for name, value in (("h", h), ("around", around), ("before", found[0]), ("after", found[1])):
                    made[name].append(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            made: dict[str, list] = {n: [] for n in _EXTENTS.names}
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in _SURROUNDINGS.names]
            for h, *row in zip(*columns, strict=True):
                if h != current:
                    close(current, rows, made)
                    current, rows = h, []
                rows.append(row)
            yield pa.RecordBatch.from_pydict(made, schema)
        made = {n: [] for n in _EXTENTS.names}
        close(current, rows, made)
        yield pa.RecordBatch.from_pydict(made, schema)

    schema = pa.schema([(n, pa.int64()) for n in _EXTENTS.names])
    return groups.repartition("h").sortWithinPartitions("h", "around").mapInArrow(run, _EXTENTS)


def _counted_extents(rows: DataFrame, length: int, anchor: int, n_ranges: int = RANGES) -> DataFrame:
    """Extents within groups too large to gather, by counting prefixes of two depths.

    The places ``d`` of a string around its anchor are split into ranges. All
    strings of a range share a core and lie in a hull. A core that occurs once
    rules the range out, a hull that occurs twice settles it, and what is left
    is counted string by string. Counts are partial in each task.
    """
    most = length - anchor
    width = -(-(most + 1) // n_ranges)

    def hashed(data: np.ndarray, pairs: list[tuple[int, int]]) -> np.ndarray:
        a, b = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        return hashing.RangeHash(data).of(a, b).view(np.int64)

    def columns(batch: pa.RecordBatch):
        for h, around, n, left, right in zip(
            *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _SURROUNDINGS.names), strict=True
        ):
            yield h, around, n, np.frombuffer(left[::-1] + right, np.uint8), len(left), len(right)

    def ranges(batch: pa.RecordBatch) -> dict:
        made: dict[str, list] = {n: [] for n in ("h", "around", "n", "low", "start", "stop", "core", "hull")}
        for h, around, n, data, left, right in columns(batch):
            found = []
            for low in range(0, most + 1, width):
                high = min(low + width - 1, most)
                # near an end of the text a range is cut to the strings there are
                start, stop = max(low, length - right), min(high, left)
                if start <= stop:
                    found.append((low, high, start, stop))
            if not found:
                continue
            # the bytes that all strings of the whole range share, which those of a cut one have too
            cores = hashed(data, [(left - low, left - high + length) for low, high, _, _ in found])
            hulls = hashed(data, [(left - stop, left - start + length) for _, _, start, stop in found])
            for (low, high, start, stop), core, hull in zip(found, cores.tolist(), hulls.tolist(), strict=True):
                row = (h, around, n, low, start, stop, core, hull if (start, stop) == (low, high) else None)
                for name, value in zip(made, row, strict=True):
                    made[name].append(value)
        return made

    def strings(batch: pa.RecordBatch) -> dict:
        made: dict[str, list] = {n: [] for n in ("h", "around", "n", "d", "string")}
        opened = batch.column(batch.schema.get_field_index("opened")).to_pylist()
        for (h, around, n, data, left, _), parts in zip(columns(batch), opened, strict=True):
            places = [d for part in parts for d in range(part["start"], part["stop"] + 1)]
            for d, string in zip(places, hashed(data, [(left - d, left - d + length) for d in places]).tolist(), strict=True):
                for name, value in zip(made, (h, around, n, d, string), strict=True):
                    made[name].append(value)
        return made

    longs = lambda *names: T.StructType([T.StructField(n, T.LongType()) for n in names])
    made = stage_and_release(
        arrow.flat_map(rows, ranges, longs("h", "around", "n", "low", "start", "stop", "core", "hull"), SLICE), "ranges"
    )
    cores = made.groupBy("h", "low", "core").agg(F.sum("n").alias("n_core")).where("n_core > 1")
    hulls = (
        made.where("hull is not null")
        .groupBy("h", "low", "hull")
        .agg(F.sum("n").alias("n_hull"), F.min("around").alias("first"))
        .where("n_hull > 1")
    )
    alive = made.join(cores, ["h", "low", "core"]).join(hulls, ["h", "low", "hull"], "left")
    settled = alive.where("n_hull is not null").select("h", "around", F.col("start").alias("a"), F.col("stop").alias("b"))
    # of a settled hull one member stands for the others where its core has strings in question
    opened = (
        alive.where("n_hull is null or (around = first and n_core > n_hull)")
        .groupBy("h", "around")
        .agg(F.collect_list(F.struct("start", "stop")).alias("opened"))
    )
    single = stage_and_release(
        arrow.flat_map(rows.join(opened, ["h", "around"]), strings, longs("h", "around", "n", "d", "string"), SLICE), "strings"
    )
    twice = single.groupBy("h", "d", "string").agg(F.sum("n").alias("n_string")).where("n_string > 1")
    found = single.join(twice, ["h", "d", "string"]).select("h", "around", F.col("d").alias("a"), F.col("d").alias("b"))
    return (
        settled.union(found)
        .groupBy("h", "around")
        .agg(F.max("b").alias("before"), (F.lit(length) - F.min("a")).alias("after"))
    )


def spans(keyed: DataFrame, text: str, length: int = LENGTH, anchor: int = ANCHOR, gathered: int = GATHERED) -> DataFrame:
    """``(key, spans)``: for texts with repeated strings the byte ranges these cover, unmerged."""
    long = keyed.where(F.octet_length(text) >= length).select("key", F.col(text).alias("text"))
    found = stage_and_release(arrow.flat_map(long, _anchor_rows(length, anchor), _ANCHORS, SLICE), "anchors")
    # counts are stored before rows are joined to them: adaptive execution splits a hot anchor of
    # a join whose sides are plain shuffles
    several = stage_and_release(
        found.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("low"), F.max("around").alias("high"))
        .where("n > 1")
        .select("h", (F.col("low") == F.col("high")).alias("alike")),
        "several",
    )
    met = stage_and_release(found.join(several, "h"), "met")
    discard(found, several)
    reach = length - anchor
    whole = [(F.col("at") - reach).alias("start"), (F.col("at") + length).alias("end")]
    alike = met.where("alike").select("key", *whole)
    different = met.where(~F.col("alike"))
    distinct = stage_and_release(
        different.groupBy("h", "around")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at")).alias("one"))
        .select("h", "around", "n", "one.key", "one.at"),
        "distinct",
    )
    sizes = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("size"))
    surroundings = stage_and_release(_surroundings(distinct, keyed, text, length, anchor), "surroundings")
    around = surroundings.join(sizes, "h")
    small = around.where(F.col("size") <= gathered).drop("size")
    large = around.where(F.col("size") > gathered).drop("size")
    settled = distinct.where("n > 1").select(
        "h", "around", F.lit(reach).cast("long").alias("before"), F.lit(length).cast("long").alias("after")
    )
    reached = _sorted_extents(small, length, anchor).union(settled)
    if not large.isEmpty():
        reached = reached.union(_counted_extents(large, length, anchor))
    reached = stage_and_release(
        reached.groupBy("h", "around").agg(F.max("before").alias("before"), F.max("after").alias("after")), "reached"
    )
    discard(distinct, surroundings)
    partly = different.join(reached, ["h", "around"]).select(
        "key", (F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("end")
    )
    return alike.union(partly).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, gathered: int = GATHERED
) -> DataFrame:
    """Documents with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the remaining bytes.

    A byte goes if a string of ``length`` bytes that covers it also begins
    anywhere else in the table, in the same text or another; strings never
    cross texts. Null texts count as empty; texts shorter than ``length`` stay
    whole; repeated rows are texts of their own, so each is the other's copy.
    Very long texts are read in chunks. The text column goes; columns that bear
    a new name are replaced; the others stay.
    """
    own, back = names.aside(names.without(docs, ("n_bytes", "n_removed", "n_spans", "kept")), ("key", "blob", "spans"))
    rows = _keyed(own, text)

    def run(batch: pa.RecordBatch) -> list:
        unpack = zstandard.ZstdDecompressor()
        out: list[list] = [[], [], [], []]
        blobs, lists = (batch.column(batch.schema.get_field_index(n)) for n in ("blob", "spans"))
        found, edges = lists.flatten(), np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())])
        starts, ends = found.field("start").to_pylist(), found.field("end").to_pylist()
        for blob, first, last in zip(blobs.to_pylist(), edges, edges[1:], strict=False):
            data = unpack.decompress(blob)
            merged: list[list[int]] = []
            for start, end in sorted(zip(starts[first:last], ends[first:last], strict=True)):
                start, end = max(0, start), min(len(data), end)
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            rims = [0, *(x for span in merged for x in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(rims[::2], rims[1::2], strict=True))
            for column, value in zip(out, (len(data), len(data) - len(kept), len(merged), kept), strict=True):
                column.append(value)
        return out

    joined = _packed(rows, text).join(spans(rows, text, length, anchor, gathered), "key", "left")
    fields = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    return arrow.append(joined, run, [*fields, T.StructField("kept", T.BinaryType())], ("key", "blob", "spans"), SLICE).withColumnsRenamed(back)
