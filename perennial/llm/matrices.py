"""Packed token-id matrices by best-fit-decreasing, with binary output.

A task packs the documents it reads, a bounded run of tokens at a time, and
writes the sequences at once: ids never cross the network.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from perennial.llm import arrow, tokens

LENGTH = 2048
END_ID = 50256
PAD_ID = 50256
# Tokens packed together; what this run cannot fill stays padded.
RUN_TOKENS = 2 << 20
# Sequences of one matrix of the binary output.
MATRIX_ROWS = 64

SEQUENCES = T.StructType(
    [
        T.StructField("sequence_id", T.LongType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("doc_starts", T.ArrayType(T.LongType())),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("ids", T.BinaryType()),
        T.StructField("positions", T.BinaryType()),
    ]
)
MATRICES = T.StructType(
    [
        T.StructField("matrix_id", T.LongType()),
        T.StructField("n_rows", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("positions", T.BinaryType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("row_segments", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("doc_starts", T.ArrayType(T.LongType())),
    ]
)


class CapacityTree:
    """Open bins by what is left in them, in a segment tree over the capacities."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.counts = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.counts[node] += by
            node >>= 1

    def put(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        self._change(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a bin of the smallest capacity of at least ``least``: that and its number."""
        node = least + self.size
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.bins[capacity].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of positions of ``sizes``, each filled to ``length`` at most; ties in order of position."""
    tree, bins = CapacityTree(length), []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[item])
        if found is None:
            found = (length, len(bins))
            bins.append([])
        capacity, number = found
        bins[number].append(item)
        if capacity > sizes[item]:
            tree.put(capacity - sizes[item], number)
    return bins


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    tokenizer: str | None = None,
    run_tokens: int = RUN_TOKENS,
) -> DataFrame:
    """One row per sequence: padded ids, positions that restart with each segment, cumulative segment lengths.

    A document is its ids and an end token; one longer than ``length`` is cut
    into pieces of ``length``, the last may be shorter, and nothing is lost.
    ``ids`` and ``positions`` are little-endian unsigned 16-bit numbers, 32-bit
    if a vocabulary or ``length`` asks for it. Null and empty texts are one end
    token, a null id stays null, repeated rows are packed each, an empty table
    gives no rows, and other columns play no part.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(_packing(length, tokenizer, run_tokens), SEQUENCES)


def pack_matrices(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    tokenizer: str | None = None,
    run_tokens: int = RUN_TOKENS,
    rows: int = MATRIX_ROWS,
) -> DataFrame:
    """``matrices`` of what ``pack`` makes, stacked where it is made: sequences leave their worker as matrices only."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pack_, stack = _packing(length, tokenizer, run_tokens), _stacking(length, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pack_(batches):
            yield pa.RecordBatch.from_pydict(stack(batch), schema)

    schema = to_arrow_schema(MATRICES)
    return source.mapInArrow(run, MATRICES)


def _packing(length: int, tokenizer: str | None, run_tokens: int):
    """Over the documents of a task: batches of packed sequences."""
    fields = SEQUENCES.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        kind = "<u2" if max(encoder.tokenizer.get_vocab_size(), length) <= 1 << 16 else "<u4"
        made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        pieces: list[tuple] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal made
            columns: list[list] = [[] for _ in fields]
            for items in best_fit_decreasing([len(p[2]) for p in pieces], length):
                chosen = [pieces[i] for i in items]
                edges = np.cumsum([0, *(len(p[2]) for p in chosen)])
                ids, positions = np.full(length, PAD_ID, kind), np.zeros(length, kind)
                ids[: edges[-1]] = np.concatenate([p[2] for p in chosen])
                positions[: edges[-1]] = np.arange(edges[-1]) - np.repeat(edges[:-1], np.diff(edges))
                row = (made, int(edges[-1]), [p[0] for p in chosen], [p[1] for p in chosen], edges.tolist())
                for column, value in zip(columns, (*row, ids.tobytes(), positions.tobytes()), strict=True):
                    column.append(value)
                made += 1
            pieces.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=fields
            )

        for whole in batches:
            for batch in arrow.slices(whole):
                for doc_id, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids = np.append(encoder.encode(value), np.uint32(END_ID))
                    for start in range(0, len(ids), length):
                        pieces.append((doc_id, start, ids[start : start + length]))
                    held += len(ids)
                    if held >= run_tokens:
                        yield close()
                        held = 0
        if pieces:
            yield close()

    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return run


def matrices(sequences: DataFrame, length: int = LENGTH, rows: int = MATRIX_ROWS) -> DataFrame:
    """Sequences stacked to matrices of at most ``rows`` rows, with segment lengths cumulated over the matrix.

    ``row_segments`` has the number of segments of each row, ``doc_ids`` and
    ``doc_starts`` the document and place of every segment. Matrices are
    stacked where the sequences lie; the last one of a batch may be smaller.
    ``sequences`` takes them apart again.
    """
    return arrow.flat_map(sequences.select(*_STACKED), _stacking(length, rows), MATRICES)


_STACKED = ["sequence_id", "cu_seqlens", "doc_ids", "doc_starts", "ids", "positions"]


def _stacking(length: int, rows: int):
    """The matrices of a batch of sequences, as columns."""

    def run(batch: pa.RecordBatch) -> dict:
        made: dict[str, list] = {n: [] for n in MATRICES.names}
        named = {n: batch.column(batch.schema.get_field_index(n)) for n in _STACKED}
        for start in range(0, batch.num_rows, rows):
            part = {n: c.slice(start, rows).to_pylist() for n, c in named.items()}
            segments = [np.diff(edges) for edges in part["cu_seqlens"]]
            row = (
                part["sequence_id"][0],
                len(segments),
                length,
                b"".join(part["ids"]),
                b"".join(part["positions"]),
                np.cumsum([0, *np.concatenate(segments)]).tolist(),
                [len(s) for s in segments],
                [i for row_ids in part["doc_ids"] for i in row_ids],
                [i for row_starts in part["doc_starts"] for i in row_starts],
            )
            for name, value in zip(made, row, strict=True):
                made[name].append(value)
        return made

    return run


def write(stacked: DataFrame, path: str) -> None:
    """Write matrices as Parquet files of binary rows, one file for each task's sequences.

    Tasks write what they pack, so a retried task writes its own file again.
    Existing files are an error; no sequences leave an empty table.
    """
    stacked.write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Written matrices."""
    return spark.read.schema(MATRICES).parquet(path)


def sequences(stacked: DataFrame) -> DataFrame:
    """The rows of matrices as ``pack`` made them: one row per sequence, its segments counted from 0.

    A matrix is cut to rows as one list, so that only a row's own bytes go on.
    """
    sums = lambda values: F.aggregate(values, F.lit(0), lambda a, b: a + b)
    width = lambda name: (F.octet_length(name) / F.col("n_rows")).cast("int")

    def row(at: Column) -> Column:
        n = F.get("row_segments", at)
        before = sums(F.slice("row_segments", F.lit(1), at))
        edges = F.slice("cu_seqlens", before + 1, n + 1)
        bytes_of = lambda name: F.substring(name, at * width(name) + 1, width(name)).alias(name)
        of_segments = lambda name: F.slice(name, before + 1, n).alias(name)
        return F.struct(
            (F.col("matrix_id") + at).alias("sequence_id"),
            (F.element_at(edges, -1) - F.element_at(edges, 1)).alias("n_tokens"),
            of_segments("doc_ids"),
            of_segments("doc_starts"),
            edges.alias("edges"),
            bytes_of("ids"),
            bytes_of("positions"),
        )

    rows = stacked.select(F.inline(F.transform(F.sequence(F.lit(0), F.col("n_rows") - 1), row)))
    return rows.select(
        "sequence_id",
        "n_tokens",
        "doc_ids",
        "doc_starts",
        F.transform("edges", lambda x: x - F.element_at("edges", 1)).alias("cu_seqlens"),
        "ids",
        "positions",
    )


def matrix(data: bytes, n_rows: int, length: int) -> np.ndarray:
    """A written matrix as an array of ids or positions."""
    kind = "<u2" if len(data) == 2 * n_rows * length else "<u4"
    return np.frombuffer(data, kind).reshape(n_rows, length)
