"""Ranked lexical search with bag deduplication.

The items are a stated query set, searched against all documents in blocks of a
fixed size. Only an item's words matter to its scores, so a document is reduced
to its bag: how often it holds each word of the block's vocabulary, and the
norm that its length gives it. Documents of one bag score alike. They form a
class, told by a hash and compared in full; a class is scored once and its
members take part in the ranking by ascending id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm import arrow
from perennial.llm.decontaminate import BLOCK_BYTES, _FOLD, words
from perennial.session import stage

BEST = 10
# Bytes of a text whose words are held at once.
CHUNK = 4 << 20
# Pairs of a class's word and an item that are added up at once.
PAIRS = 1 << 20
_LAST = np.iinfo(np.int64).max

BAG = [
    T.StructField("n", T.LongType()),
    T.StructField("terms", T.ArrayType(T.IntegerType())),
    T.StructField("counts", T.ArrayType(T.IntegerType())),
]
SCORED = T.StructType(
    [T.StructField("item", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]
)


def counted(text: str | None) -> Counter:
    """How often each word occurs, words as UTF-8 with A-Z lower-cased; none for null."""
    found: Counter = Counter()
    data = b"" if text is None else text.encode("utf-8").translate(_FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


class Block:
    """Some items: their vocabulary, and for each word the items that hold it."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.numbers = np.array([number for number, _ in items], np.int64)
        holders: dict[bytes, list[int]] = {}
        for place, (_, text) in enumerate(items):
            for term in dict.fromkeys(words(text)):
                holders.setdefault(term, []).append(place)
        self.vocabulary = {term: i for i, term in enumerate(holders)}
        self.lengths = np.array([len(x) for x in holders.values()], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.items = np.array([i for x in holders.values() for i in x], np.int64)


def weight(n_docs: int, df: int) -> int:
    """A word's weight: the rarer, the higher."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def bags(docs: DataFrame, sent, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n, terms, counts``: words with repeats, and the vocabulary's words with their counts, in order."""

    def run(batch: pa.RecordBatch) -> list:
        vocabulary = sent.value.vocabulary
        lengths, terms, counts = [], [], []
        for value in batch.column(1).to_pylist():
            found = counted(value)
            held = sorted((vocabulary[term], found[term]) for term in found.keys() & vocabulary.keys())
            lengths.append(found.total())
            terms.append([t for t, _ in held])
            counts.append([c for _, c in held])
        return [lengths, terms, counts]

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("body"))
    return arrow.append(narrow, run, BAG, drop=("body",))


def classes(bagged: DataFrame, n_docs: int, n_words: int, best: int = BEST) -> DataFrame:
    """One row for each distinct bag that holds a word of the vocabulary: ``m, terms, counts, members``.

    A class is told by its hash and compared in full (grouping compares all of
    its key). Of its members only the ``best`` smallest ids can be ranked; each
    task leaves out the others before anything is shuffled, so the copies of
    one text never meet as a whole. Missing ids come last.
    """
    norm = F.expr(f"100 - 90 + (90 * n * {n_docs}L) div {max(1, n_words)}L").alias("m")
    key = ["hash", "m", "terms", "counts"]
    keyed = bagged.where(F.size("terms") > 0).select("id", norm, "terms", "counts")
    hashed = keyed.withColumn("hash", F.xxhash64("m", "terms", "counts"))
    order = Window.partitionBy(*key).orderBy(F.col("id").asc_nulls_last())
    members = hashed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= best)
    grouped = members.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("members"))
    return grouped.select("m", "terms", "counts", F.col("members.id").alias("members"))


class _Best:
    """The classes that may be ranked, for each item, among those seen so far."""

    def __init__(self, n_items: int, best: int):
        self.best = best
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.members = np.zeros(0, object)
        # a class below an item's bar cannot be ranked any more
        self.bar = np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, first: np.ndarray, members: np.ndarray) -> None:
        """Take in the scores of some classes (rows) for all items (columns)."""
        row, item = np.nonzero(scores >= self.bar)
        if not len(row):
            return
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, scores[row, item]])
        self.first = np.concatenate([self.first, first[row]])
        self.members = np.concatenate([self.members, members[row]])
        order = np.lexsort((self.first, -self.score, self.item))
        sorted_items = self.item[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        last = order[place == self.best - 1]
        self.bar[self.item[last]] = self.score[last]
        order = order[place < self.best]
        self.item, self.score, self.first, self.members = (x[order] for x in (self.item, self.score, self.first, self.members))


def _scoring(sent, weights: np.ndarray, best: int):
    """Over the classes of a task: each item's best members among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = sent.value
        n_items = len(block.numbers)
        kept = _Best(n_items, best)
        lengths = np.where(weights > 0, block.lengths, 0)
        for batch in batches:
            sizes = np.asarray(batch.column(1).value_lengths())
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            terms = np.asarray(batch.column(1).flatten()).astype(np.int64)
            counts = np.asarray(batch.column(2).flatten()).astype(np.int64)
            norms = np.asarray(batch.column(0)).astype(np.int64)
            gain = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * norms[owner]))
            ids = batch.column(3).to_pylist()
            members = np.empty(len(ids), object)
            members[:] = ids
            first = np.array([_LAST if x[0] is None else x[0] for x in ids], np.int64)
            pairs = np.cumsum(np.bincount(owner, lengths[terms], batch.num_rows))
            ends = np.cumsum(sizes)
            at = 0
            while at < batch.num_rows:
                done = pairs[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(pairs, done + PAIRS, "right")))
                end = min(end, at + max(1, PAIRS // n_items))
                part = slice(ends[at - 1] if at else 0, ends[end - 1])
                n = lengths[terms[part]]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                item = block.items[np.repeat(block.starts[terms[part]], n) + within]
                scores = np.zeros((end - at) * n_items, np.int64)
                np.add.at(scores, np.repeat(owner[part] - at, n) * n_items + item, np.repeat(gain[part], n))
                kept.add(scores.reshape(-1, n_items), first[at:end], members[at:end])
                at = end
        sizes = [len(x) for x in kept.members]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(block.numbers[kept.item], sizes), pa.int64()),
                pa.array([i for x in kept.members for i in x], pa.int64()),
                pa.array(np.repeat(kept.score, sizes), pa.int64()),
            ],
            names=SCORED.names,
        )

    return run


def _top(scored: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def rank(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each item's ``best`` highest-scoring documents with a score above 0: ``item_id, rank, doc_id, score``.

    Equal scores are ranked by ascending id, missing ids last. Null and empty
    texts have no words: such documents count nowhere and such items find
    nothing. Repeated rows are documents of their own; repeated items, and
    items without an id, get a list each. Other columns play no part, whatever
    their names. An empty table gives no rows.

    Statistics cover all documents. Items beyond ``block_bytes`` are searched in
    several passes over the documents, each stored before the next. The driver
    holds one block of items, its words and their document counts.
    """
    numbered = stage(
        items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).alias("body")),
        "search-items",
    )
    total = numbered.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    found: DataFrame | None = None
    for number in range(n_blocks):
        part = numbered.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == number).where("body is not null")
        one = _search(docs, Block([(r["item"], r["body"]) for r in part.collect()]), best, id_col, text)
        one = stage(one, "search-results") if n_blocks > 1 else one
        found = one if found is None else found.unionByName(one)
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, block: Block, best: int, id_col: str, text: str) -> DataFrame:
    """``item, rank, doc_id, score`` for one block of items."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    bagged = stage(bags(docs, sent, id_col, text), "bags")
    n_docs, n_words = bagged.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(block.vocabulary), np.int64)
    for term, df in bagged.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(n_docs, df)
    grouped = classes(bagged, n_docs, n_words, best)
    scored = grouped.mapInArrow(_scoring(sent, weights, best), SCORED)
    return _top(scored, best)
