"""Benchmark decontamination by Wu-Manber search over words.

The benchmark is a stated query set. Its items are dealt into blocks of a fixed
size, each sent to the tasks once; the documents stream past them and are never
shuffled. Words stand where the classic method has characters: a block is two
words, and a position whose block is in no window is skipped by nearly a whole
window.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm import arrow, names
from perennial.session import stage

WINDOW = 10
MADE = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated")
# Text of the items sent to the tasks at once.
BLOCK_BYTES = 8 << 20

# Blocks searched in one pass over the documents; their tables are held side by side.
CHAINED = 4

# Bytes of words with A-Z in lower case; every other byte parts words. A character
# beyond ASCII is a word character, and so is each of its bytes in UTF-8.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased, as UTF-8; none for null."""
    return [] if text is None else text.encode("utf-8").translate(_FOLD).split()


class WuManber:
    """Search of word patterns of one length in word sequences."""

    def __init__(self, length: int):
        self.length = length
        self.skip = max(1, length - 1)
        self.shift: dict = {}
        # last block -> first block -> (pattern, ids)
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        self._ids: dict = {}

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        """Add a pattern that stands for an item."""
        if pattern in self._ids:
            self._ids[pattern].add(item)
            return
        ids = self._ids[pattern] = {item}
        last = self.length - 1
        for end in range(min(1, last), self.length):
            block = pattern[max(0, end - 1) : end + 1]
            self.shift[block] = min(self.shift.get(block, self.skip), last - end)
        self.buckets[pattern[-2:]][pattern[:2]].append((pattern, ids))

    def search(self, text: list[bytes], spans: list[tuple[int, int]], found: set[str]) -> None:
        """Add the spans of all occurrences, ends exclusive, and the ids of their items."""
        length, shift, skip, buckets = self.length, self.shift, self.skip, self.buckets
        at, end = length - 1, len(text)
        width = 1 if length == 1 else 2
        while at < end:
            block = tuple(text[at - width + 1 : at + 1])
            step = shift.get(block, skip)
            if step:
                at += step
                continue
            start = at - length + 1
            for pattern, ids in buckets[block].get(tuple(text[start : start + 2]), ()) if length > 1 else buckets[block][block]:
                if tuple(text[start : at + 1]) == pattern:
                    spans.append((start, at + 1))
                    found |= ids
                    break
            at += 1


def matchers(items: list[tuple[str, str | None]], window: int = WINDOW) -> list[WuManber]:
    """One matcher for each length of the items' windows; an item of fewer words is one window."""
    by_length: dict[int, WuManber] = {}
    for item, text in items:
        ws = tuple(words(text))
        length = min(window, len(ws))
        if length:
            matcher = by_length.setdefault(length, WuManber(length))
            for start in range(len(ws) - length + 1):
                matcher.add(ws[start : start + length], item)
    return list(by_length.values())


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Starts and ends of the union of spans, in order, flat."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    """The items in blocks of about ``block_bytes``, one block on the driver at a time."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")
    ).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for block in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block) if n > 1 else items
        yield block == n - 1, [(r["id"], r["text"]) for r in part.collect()]


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    drop: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add what of the benchmark each document holds.

    New columns: ``n_words``, ``n_hit`` (words inside any occurrence),
    ``n_items``, ``items`` (ids as strings, sorted), ``spans`` (starts and ends
    of hit word runs, flat) and ``contaminated``. Columns of these names are
    replaced, those in ``drop`` left out, the others stay. Null and empty texts
    have no words and no hits; null items and items without words occur
    nowhere; a null item id counts as the empty string; repeated rows are
    judged alike; an empty benchmark hits nothing. A benchmark beyond
    ``block_bytes`` is searched block by block, and the documents with what was
    found so far are stored after every few blocks.
    """
    context = docs.sparkSession.sparkContext
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
    out = names.without(docs, MADE)
    for number, (last, block) in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        if number and number % CHAINED == 0:
            # the tables of the blocks so far leave the workers
            out = stage(out, "searched")
        sent = context.broadcast(block)
        out = arrow.append(out, _searching(sent, text, window, number > 0), fields, drop if last else ())
    # e2 - (s2 - (e1 - s1)): over pairs of start and end the signs leave the summed lengths
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: x.cast("long") - acc)
    return out.withColumns(
        {
            "n_hit": n_hit,
            "items": F.sort_array(F.array_distinct("items")),
            "n_items": F.size(F.array_distinct("items")).cast("long"),
            "contaminated": F.size("spans") > 0,
        }
    )


def _searching(sent, text: str, window: int, later: bool):
    tables: list = []

    def run(batch: pa.RecordBatch) -> list:
        if not tables:
            tables.append(matchers(sent.value, window))
        names = batch.schema.names
        before = (
            zip(batch.column(names.index("spans")).to_pylist(), batch.column(names.index("items")).to_pylist(), strict=True)
            if later
            else None
        )
        counts, all_spans, all_items = [], [], []
        for value in batch.column(names.index(text)).to_pylist():
            ws = words(value)
            spans: list[tuple[int, int]] = []
            found: set[str] = set()
            if before is not None:
                old, ids = next(before)
                spans += zip(old[::2], old[1::2], strict=True)
                found |= set(ids)
            for matcher in tables[0]:
                matcher.search(ws, spans, found)
            counts.append(len(ws))
            all_spans.append(merged(spans))
            all_items.append(sorted(found))
        return [counts, all_spans, all_items]

    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that hold no window of the benchmark, with their own columns only."""
    renamed, back = names.aside(docs, MADE)
    found = find(renamed, benchmark, text, **options)
    return found.where(~F.col("contaminated")).drop(*MADE).withColumnsRenamed(back)
