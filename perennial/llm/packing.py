"""Best-fit packing improved by swap-based local search.

Documents are tokenised where they lie and leave one small row for each piece.
Pieces are dealt into groups of bounded size; each group is packed by best fit
and then improved by moves and exchanges that raise the squared fill of its
bins until bins run empty. The emptiest bins of all groups meet again in fewer
groups, so that what a group could not fill is filled with others' pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm import arrow, tokens
from perennial.session import stage

LENGTH = 2048
END_ID = 0
# Pieces packed together by one task.
GROUP = 20_000
# Bins filled less than this share are passed on to meet those of other groups ...
FULL = 0.98
# ... as long as a round empties at least this share of the bins that met.
LEAST_GAIN = 0.002

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Starts and ends of the pieces of ``n`` tokens: full ones, the first takes what is over."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first)] + [(s, s + length) for s in range(first, n, length)]


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, tokenizer: str | None = None
) -> DataFrame:
    """One row for each piece of each document; null and empty texts are one end token."""

    def run(batch: pa.RecordBatch) -> dict:
        made: dict[str, list] = defaultdict(list)
        encode = tokens.encoder(tokenizer).encode
        ids = batch.column(0).to_pylist()
        for doc_id, value in zip(ids, batch.column(1).to_pylist(), strict=True):
            whole = np.append(encode(value), np.uint32(END_ID)).astype("<u4")
            for number, (start, end) in enumerate(cuts(len(whole), length)):
                for name, value in zip(
                    PIECES.names,
                    (doc_id, number, start, end - start, zlib.crc32(whole[start:end].tobytes())),
                    strict=True,
                ):
                    made[name].append(value)
        return made

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow.flat_map(source, run, PIECES)


class Index:
    """Which bins hold a value; the values that are held stand as bits of a number."""

    def __init__(self):
        self.bins: dict[int, set[int]] = defaultdict(set)
        self.values: dict[int, list[int]] = {}
        self.present = 0

    def add(self, b: int, values: list[int]) -> None:
        self.values[b] = values
        for value in values:
            self.bins[value].add(b)
            self.present |= 1 << value

    def forget(self, b: int) -> None:
        for value in self.values.pop(b, ()):
            held = self.bins[value]
            held.discard(b)
            if not held:
                self.present &= ~(1 << value)

    def largest(self, limit: int) -> int:
        """The largest value up to a limit, 0 if there is none."""
        return max((self.present & ((2 << limit) - 1)).bit_length() - 1, 0)

    def holder(self, value: int) -> int:
        return next(iter(self.bins[value]))


class Bins:
    """Bins of one group: sizes per bin, improved in place."""

    def __init__(self, sizes: list[int], length: int = LENGTH):
        self.length = length
        self.items: list[Counter] = []
        self.fill: list[int] = []
        self._best_fit(sizes)

    def _best_fit(self, sizes: list[int]) -> None:
        """Largest first, each into the fullest bin it fits; a bit set holds the gaps there are."""
        gaps: dict[int, list[int]] = defaultdict(list)
        there = 0
        for size in sorted(sizes, reverse=True):
            fitting = there >> size
            if fitting:
                gap = size + (fitting & -fitting).bit_length() - 1
                at = gaps[gap].pop()
                if not gaps[gap]:
                    there &= ~(1 << gap)
            else:
                gap, at = self.length, len(self.items)
                self.items.append(Counter())
                self.fill.append(0)
            self.items[at][size] += 1
            self.fill[at] += size
            if gap > size:
                gaps[gap - size].append(at)
                there |= 1 << (gap - size)

    def _shift(self, source: int, target: int, given: tuple[int, ...], taken: tuple[int, ...]) -> None:
        """Give documents of these sizes to the target, take others back."""
        for a, b, sizes in ((source, target, given), (target, source, taken)):
            for size in sizes:
                self.items[a][size] -= 1
                if not self.items[a][size]:
                    del self.items[a][size]
                self.items[b][size] += 1
                self.fill[a] -= size
                self.fill[b] += size

    def improve(self) -> None:
        """Raise the squared fill until no move or exchange into a bin that is at least as full does.

        The fullest bin with a gap is served first, from bins that are no
        fuller at that moment: whatever moves up raises the sum of squares.
        Rounds follow each other until one finds no step.
        """
        while self._serve_all():
            pass
        kept = [b for b in range(len(self.fill)) if self.fill[b]]
        self.items, self.fill = [self.items[b] for b in kept], [self.fill[b] for b in kept]

    def _serve_all(self) -> int:
        """Serve every bin with a gap once, by current fill; the number of steps taken."""
        order = [b for b in range(len(self.fill)) if 0 < self.fill[b] < self.length]
        # who holds a piece of a size, and two pieces of a sum
        holders, pairs = Index(), Index()

        def offer(b: int) -> None:
            holders.add(b, list(self.items[b]))
            pairs.add(b, self._pair_sums(b))

        for b in order:
            offer(b)
        steps = 0
        waiting = [(-self.fill[b], b) for b in order]
        heapify(waiting)
        while waiting:
            fill, target = heappop(waiting)
            # a bin that has given since then waits with its new fill, too
            if -fill != self.fill[target] or target not in holders.values:
                continue
            holders.forget(target)
            pairs.forget(target)
            while 0 < self.fill[target] < self.length:
                step = self._best_step(target, holders, pairs)
                if not step:
                    break
                source, given, taken = step
                holders.forget(source)
                pairs.forget(source)
                self._shift(source, target, given, taken)
                steps += 1
                if self.fill[source]:
                    offer(source)
                    heappush(waiting, (-self.fill[source], source))
        return steps

    def _pair_sums(self, b: int) -> list[int]:
        """The sums of two pieces of a bin."""
        counts, sums = self.items[b], 0
        ones = sum(1 << size for size in counts)
        for size, n in counts.items():
            sums |= (ones if n > 1 else ones & ~(1 << size)) << size
        return [at for at, bit in enumerate(bin(sums)[:1:-1]) if bit == "1"]

    def _best_step(self, target, holders, pairs):
        """The step that adds most to the target: a move, one for one, or two for one, of all bins that are still to be served."""
        gap = self.length - self.fill[target]
        best = holders.largest(gap)
        found = (holders.holder(best), (best,), ()) if best else None
        for own in self.items[target]:
            if best == gap:
                return found
            size = holders.largest(own + gap)
            if size - own > best:
                best, found = size - own, (holders.holder(size), (size,), (own,))
        for own in self.items[target]:
            if best == gap:
                return found
            total = pairs.largest(own + gap)
            if total - own > best:
                source = min(pairs.bins[total], key=self.fill.__getitem__)
                counts = self.items[source]
                first = next(s for s in counts if counts.get(total - s, 0) > (total == 2 * s))
                best, found = total - own, (source, (first, total - first), (own,))
        return found


def assign(lengths: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """For items of these lengths their bin and place there, and the fill of each bin."""
    bins = Bins([int(x) for x in lengths], length)
    bins.improve()
    waiting: dict[int, list[int]] = defaultdict(list)
    for row in np.argsort(lengths, kind="stable")[::-1]:
        waiting[int(lengths[row])].append(int(row))
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, counts in enumerate(bins.items):
        at = 0
        for size in sorted(counts, reverse=True):
            for _ in range(counts[size]):
                row = waiting[size].pop()
                where[row], offset[row] = number, at
                at += size
    return where, offset, bins.fill


def _packed_groups(rows: DataFrame, n_groups: int, number: int, last: bool, length: int) -> DataFrame:
    """Pack each group; ``open`` marks the pieces of its underfilled bins unless one group has all."""
    schema = T.StructType(
        PIECES.fields
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("open", T.BooleanType())]
    )

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        where, offset, fill = assign(pdf["length"].to_numpy(), length)
        passed = [] if last else [b for b in range(len(fill)) if fill[b] < FULL * length]
        # odd numbers: round, group and bin; even ones are the full pieces
        ids = (((number << 24) + int(key[0])) << 32) + where
        out = pdf[PIECES.names].copy()
        out["sequence_id"], out["offset"], out["open"] = ids * 2 + 1, offset, np.isin(where, passed)
        return out

    dealt = rows.withColumn(
        "_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_groups)).cast("long")
    )
    return dealt.groupBy("_group").applyInPandas(run, schema)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    tokenizer: str | None = None,
    group: int = GROUP,
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    Null and empty texts are one end token, repeated rows are packed each, a
    null id stays null, an empty table gives no rows, other columns play no
    part. Which of several pieces of one length goes where is arbitrary.
    Nothing but counts reaches the driver; a group holds about ``group``
    pieces, dealt by row number, so hot ids do not meet. Bins filled less than
    ``FULL`` meet those of other groups in further rounds, until one group holds
    them all or a round empties less than ``LEAST_GAIN`` of them.
    """
    rows = stage(pieces(docs, id_col, text, length, tokenizer), "pieces")
    full = rows.where(F.col("length") == length).select(
        *PIECES.names,
        (F.monotonically_increasing_id() * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    out, rest, number = full, rows.where(F.col("length") < length), 0
    n, met = rest.count(), None
    while n:
        n_groups = -(-n // group)
        packed = stage(_packed_groups(rest, n_groups, number, n_groups == 1, length), "packed")
        # every bin has one piece at its beginning
        begins = F.col("offset") == 0
        bins, n, open_bins = packed.agg(F.count_if(begins), F.count_if("open"), F.count_if(begins & F.col("open"))).first()
        out = out.union(packed.where(~F.col("open")).select(out.columns))
        if met is not None and bins > (1 - LEAST_GAIN) * met:
            return out.union(packed.where("open").select(out.columns))
        rest, met, number = packed.where("open").select(*PIECES.names), open_bins, number + 1
    return out
