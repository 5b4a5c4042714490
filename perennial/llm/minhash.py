"""MinHash near-dedup: universal hash minima, banding, verification, components.

Equal word sequences are one class and meet as one row. Bands propose pairs of
classes: all pairs of a small bucket, every member with one leader in a large
one. Signatures and then full shingle sets confirm them. What the leaders of
large buckets may have missed is found exactly, by the rarest shingles of the
members that are still in different components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.llm import arrow, hashing, names
from perennial.llm.cleanup import stage_and_release
from perennial.llm.components import components
from perennial.session import stage

SHINGLE = 5
# A pair at the threshold of 0.75 shares no band with probability (1 - 0.75^6)^60 < 1e-5.
BANDS = 60
ROWS = 6
# Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
# Bytes of the signature used to verify candidates; at 0.75 the estimate's deviation is 0.027.
SIGNATURE = 256
# Estimates below this are no links: more than seven deviations under the threshold.
ESTIMATE = 0.55
# Buckets up to this size give all their pairs, larger ones one leader for each band.
SMALL = 16
# Bytes of a batch that a task works on at once; minima and unpacked texts are a few times that.
SLICE = 2 << 20

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_FACTORS = (hashing.seeded(BANDS * ROWS, 1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADDENDS = (hashing.seeded(BANDS * ROWS, 2) >> np.uint64(32)).astype(np.uint32)
_BLOCK = 1024


def shingles(text: bytes) -> np.ndarray:
    """The set of shingle hashes of a text in UTF-8, sorted."""
    return np.unique(hashing.run_hashes(hashing.word_hashes(text.translate(_FOLD)), SHINGLE))


def minima(items: np.ndarray) -> np.ndarray:
    """For every universal hash its minimum over a set that isn't empty."""
    folded = (items >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    buffer = np.empty((len(_FACTORS), min(_BLOCK, len(folded))), np.uint32)
    for start in range(0, len(folded), _BLOCK):
        part = folded[start : start + _BLOCK]
        view = buffer[:, : len(part)]
        np.multiply(_FACTORS[:, None], part[None, :], out=view)
        view += _ADDENDS[:, None]
        np.minimum(out, view.min(axis=1), out=out)
    return out


def _band_keys(lows: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row of minima; the band's number is part of it."""
    parts = lows.reshape(len(lows), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        keys = hashing.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def _described(text: str):
    def run(batch: pa.RecordBatch) -> list:
        counts, keys, lows, filled = [], [], [], []
        for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
            items = shingles(value.encode("utf-8")) if value else ()
            counts.append(len(items))
            filled.append(bool(len(items)))
            if len(items):
                # the class of a text: its words in order
                ordered = b" ".join(value.encode("utf-8").translate(_FOLD).split())
                keys.append(hashlib.blake2b(ordered, digest_size=16).digest())
                lows.append(minima(items))
            else:
                keys.append(None)
        bands: list = [None] * len(counts)
        signatures: list = [None] * len(counts)
        if lows:
            table = np.stack(lows)
            made = _band_keys(table)
            low = (hashing.mixed(table[:, :SIGNATURE].astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
            for place, row in enumerate(np.flatnonzero(filled)):
                bands[row] = made[place]
                signatures[row] = low[place].tobytes()
        return [counts, keys, bands, signatures]

    return run


def describe(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_shingles``, ``key`` (class), ``bands`` and ``signature`` of each document."""
    return arrow.append(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")),
        _described("text"),
        [
            T.StructField("n_shingles", T.LongType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("signature", T.BinaryType()),
        ],
        drop=("text",),
        limit=SLICE,
    )


def _packed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Ids and compressed texts, to be looked up by the verification."""

    def run(batch: pa.RecordBatch) -> list:
        press = zstandard.ZstdCompressor(level=3)
        column = batch.column(batch.schema.get_field_index("text")).to_pylist()
        return [[press.compress(v.encode("utf-8")) for v in column]]

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).where(
        "id is not null and text is not null"
    )
    return arrow.append(rows, run, [T.StructField("blob", T.BinaryType())], drop=("text",), limit=SLICE)


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree well enough to be links."""

    def run(batch: pa.RecordBatch) -> list:
        a, b = (
            np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(n)).to_pylist()), np.uint8).reshape(-1, SIGNATURE)
            for n in ("sa", "sb")
        )
        # bytes of different minima agree once in 256 times
        share = ((a == b).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
        return [(share >= ESTIMATE).tolist()]

    sides = [
        classes.select(F.col("id").alias(x), F.col("signature").alias(f"s{x}"), F.col("n_shingles").alias(f"n{x}"))
        for x in "ab"
    ]
    joined = (
        pairs.join(sides[1], "b").join(sides[0], "a")
        # sets whose sizes differ by more cannot reach the threshold
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)
        .select("a", "b", "sa", "sb")
    )
    checked = arrow.append(joined, run, [T.StructField("agree", T.BooleanType())], drop=("sa", "sb"), limit=SLICE)
    return checked.where("agree").select("a", "b")


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are links by their full shingle sets, as ``(u, v)``."""

    def run(batch: pa.RecordBatch) -> list:
        unpack = zstandard.ZstdDecompressor()
        names = batch.schema.names
        last, mine, out = None, None, []
        for a, x, y in zip(*(batch.column(names.index(n)).to_pylist() for n in ("a", "xa", "xb")), strict=True):
            if last != (a, x):
                last, mine = (a, x), shingles(unpack.decompress(x))
            other = shingles(unpack.decompress(y))
            common = len(np.intersect1d(mine, other, assume_unique=True))
            out.append(100 * common >= PERCENT * (len(mine) + len(other) - common))
        return [out]

    joined = pairs.join(texts.select(F.col("id").alias("b"), F.col("blob").alias("xb")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("blob").alias("xa")), "a"
    )
    checked = arrow.append(
        joined.select("a", "b", "xa", "xb"), run, [T.StructField("linked", T.BooleanType())], drop=("xa", "xb"), limit=SLICE
    )
    return checked.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _buckets(classes: DataFrame) -> DataFrame:
    """Members of the buckets that hold two classes or more, with the bucket's size and leader.

    The leader is drawn by a hash of member and bucket, so that it differs
    from band to band.
    """
    bands = classes.select("id", F.explode("bands").alias("bucket"))
    # stored before members are joined to them: adaptive execution splits a hot bucket of a join
    # whose sides are plain shuffles
    sizes = stage(
        bands.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("id", "bucket").alias("h"), "id")).alias("low"))
        .where("n > 1")
        .select("bucket", "n", F.col("low.id").alias("leader")),
        "bucket-sizes",
    )
    return bands.join(sizes, "bucket")


def _candidates(members: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b``: all of small buckets, member and leader of large ones."""
    large = members.where((F.col("n") > SMALL) & (F.col("id") != F.col("leader"))).select(
        F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")
    )
    small = (
        members.where(F.col("n") <= SMALL)
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))  # SMALL at most
        .select("ids")
        .distinct()
    )
    pairs = small.select(F.explode(F.sequence(F.lit(0), F.size("ids") - 2)).alias("i"), "ids").select(
        F.get("ids", F.col("i")).alias("a"),
        F.explode(F.slice("ids", F.col("i") + 2, F.size("ids"))).alias("b"),
    )
    return large.union(pairs).where("a < b").distinct()


def _rest(members: DataFrame, labels: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Candidate pairs of large buckets between components, complete.

    Two sets that are links share one of their rarest quarter of shingles.
    Only classes whose bucket holds several components take part, and only
    shingles that several components share give pairs. Shingles are ordered by
    their count in these classes, so a passage that all of them carry comes last.
    """
    large = members.where(F.col("n") > SMALL).select("bucket", "id")
    labelled = large.join(labels, large["id"] == labels["node"], "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("label")
    )
    mixed = (
        labelled.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l < h").select("bucket")
    )
    open_classes = labelled.join(mixed, "bucket").select("id", "label").distinct()

    def run(batch: pa.RecordBatch) -> list:
        column = batch.column(batch.schema.get_field_index("text")).to_pylist()
        return [[shingles(v.encode("utf-8")).view(np.int64) for v in column]]

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null")
    sets = arrow.append(
        texts.join(open_classes, "id"), run, [T.StructField("set", T.ArrayType(T.LongType()))], drop=("text",), limit=SLICE
    )
    sets = stage_and_release(sets, "open-sets")
    items = sets.select("id", "label", F.size("set").alias("n"), F.explode("set").alias("item"))
    counts = items.groupBy("item").agg(
        F.count(F.lit(1)).alias("df"), F.min("label").alias("l"), F.max("label").alias("h")
    )
    # a set's order needs only its items that others have too: the rest come first
    shared = items.join(counts.where("df > 1"), "item")
    ordered = shared.groupBy("id", "label", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "item", (F.col("l") < F.col("h")).alias("open")))).alias("items")
    )
    alone = F.col("n") - F.size("items")
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(PERCENT) / F.lit(100)) + 1 - alone
    # with its place in the set's order, which bounds what two sets can still share from there on
    rare = ordered.select(
        "id", "label", "n", alone.alias("alone"), F.posexplode(F.slice("items", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int")))
    ).where("col.open").select("id", "label", "n", "col.item", (F.col("n") - F.col("alone") - F.col("pos")).alias("left"))
    near = F.col("n_b") * 100 >= F.col("n_a") * PERCENT
    enough = F.least("left_a", "left_b") * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT
    return (
        _meeting(rare)
        .where((F.col("label_a") != F.col("label_b")) & near & enough)
        .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
        .distinct()
    )


# Sizes of one class differ by five per cent at most.
_CLASSES = 20


def _meeting(rare: DataFrame) -> DataFrame:
    """Pairs of sets that share a rare item and whose sizes leave room for a link.

    From an item on, a set has ``left`` items that another can share, so a link
    to a set that is not larger needs one of at most ``left * 175 / 75 - n``
    items. Sets meet by item and class of size: those of one template that share
    too little for their size never meet, however many there are.
    """
    size_class = lambda n: F.floor(F.ln(n) * _CLASSES).cast("int")
    low = F.ceil(F.col("n") * F.lit(PERCENT) / F.lit(100))
    high = F.least(F.col("n"), F.floor(F.col("left") * F.lit(100 + PERCENT) / F.lit(PERCENT)) - F.col("n"))
    columns = ("id", "label", "n", "left")
    larger = rare.where(high >= low).select(
        "item",
        *[F.col(c).alias(f"{c}_a") for c in columns],
        F.explode(F.sequence(size_class(low), size_class(high))).alias("class"),
    )
    other = rare.select("item", *[F.col(c).alias(f"{c}_b") for c in columns], size_class(F.col("n")).alias("class"))
    return larger.join(other, ["item", "class"]).where(F.col("n_b") <= F.col("n_a"))


def link(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` of every document.

    Null and empty texts, and texts of white space, have no shingles and link
    with nothing. Documents without an id link with nothing and are kept, with
    a null component. Rows that repeat an id are one document of the graph and
    share its component. Very long texts are hashed in chunks. Other columns
    of ``docs`` play no part, so their names cannot clash.
    """
    rows = stage(describe(docs, id_col, text), "shingled")
    filled = rows.where("key is not null and id is not null")
    first = stage(filled.groupBy("key").agg(F.min("id").alias("class_id")), "classes")
    classes = filled.join(first, "key").where("id = class_id").drop("class_id").dropDuplicates(["id"])
    members = stage_and_release(_buckets(classes.select("id", "bands")), "buckets")
    texts = _packed(docs, id_col, text)
    signed = classes.select("id", "signature", "n_shingles")
    links = stage_and_release(_confirm(_agreeing(_candidates(members), signed), texts), "links")
    labels = stage(components(links), "labels")
    if not members.where(F.col("n") > SMALL).isEmpty():
        rest = _confirm(_agreeing(_rest(members, labels, docs, id_col, text), signed), texts)
        labels = stage(components(links.union(rest)), "labels")
    of_class = stage(
        first.join(labels, first["class_id"] == labels["node"], "left").select(
            "key", F.coalesce("component", "class_id").alias("label")
        ),
        "class-labels",
    )
    found = rows.select("id", "n_shingles", "key").join(of_class, "key", "left")
    component = F.coalesce("label", "id")
    return found.select(
        "id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those linked to one with a smaller id."""
    own_id = next(names.fresh(docs.columns))
    dropped = link(docs, id_col, text).where(~F.col("kept")).select(F.col("id").alias(own_id)).distinct()
    return docs.join(dropped, docs[id_col].cast("long") == F.col(own_id), "left_anti")
