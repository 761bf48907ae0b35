"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the longest length. Pieces are dealt evenly over
shards of bounded size, and each shard is packed by itself: pieces in falling size, each
into the open bin that it fills best. If none has room, a bin is opened whose length costs
least per token once the pieces still to come are counted in: every permitted length is tried
on them. At the end each bin is cut down to the shortest permitted length that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm.common import map_batches, prepare, stored, table, text_or_empty

LENGTHS = (512, 1024, 2048, 4096)
SEQUENCE_COST = 16
"""Cost of a sequence beside its length, in tokens: a few short ones cost more than one long."""
SHARD_PIECES = 20_000
"""Pieces that one task packs."""

BINS = ("capacity int, n_tokens int, n_pieces int, "
        "pieces array<struct<doc_id: bigint, piece: int, start: int, length: int>>")


class Sizes:
    """How many pieces of each size are still to come; finds the largest that fits."""

    def __init__(self, lengths: Sequence[int], longest: int):
        self.left = np.bincount(np.asarray(lengths, np.int64), minlength=longest + 1).tolist()
        self.mask = sum(1 << size for size, n in enumerate(self.left) if n)

    def take(self, size: int) -> None:
        self.left[size] -= 1
        if not self.left[size]:
            self.mask &= ~(1 << size)

    def waste(self, room: int) -> int:
        """Room that stays when the largest fitting pieces to come are put in."""
        used: dict[int, int] = {}
        mask = self.mask
        while True:
            size = (mask & ((2 << room) - 1)).bit_length() - 1
            if size <= 0:
                return room
            n = min(self.left[size] - used.get(size, 0), room // size)
            used[size] = used.get(size, 0) + n
            room -= n * size
            mask &= (1 << size) - 1


def least_cost_length(size: int, sizes: Sizes, lengths: Sequence[int]) -> int:
    """Permitted length with the least cost per token for a bin that begins with ``size``."""
    best, least = lengths[-1], float("inf")
    for length in lengths:
        if length >= size:
            filled = length - sizes.waste(length - size)
            cost = (shortest(filled, lengths) + SEQUENCE_COST) / filled
            if cost < least:
                best, least = length, cost
    return best


def shortest(filled: int, lengths: Sequence[int]) -> int:
    return next(length for length in lengths if length >= filled)


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> list[tuple[int, list[int]]]:
    """(length, positions of pieces) of every bin. Sizes lie between 1 and the longest length;
    equal sizes keep their order."""
    lengths = sorted(lengths)
    to_come = Sizes(sizes, lengths[-1])
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins: list[list[int]] = []
    rooms: dict[int, list[int]] = {}
    open_rooms = 0
    for at in order:
        size = sizes[at]
        to_come.take(size)
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            here = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
            bins[here].append(at)
        else:
            room = least_cost_length(size, to_come, lengths)
            here = len(bins)
            bins.append([at])
        room -= size
        if room:
            rooms.setdefault(room, []).append(here)
            open_rooms |= 1 << room
    return [(shortest(sum(sizes[i] for i in held), lengths), held) for held in bins]


def document_pieces(docs: DataFrame, longest: int) -> DataFrame:
    """(doc_id, piece, start, length) in tokens: the words of a text and one end. Every row has
    at least one piece; a null or empty text is its end alone."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, number, start, length = [], [], [], []
            for doc, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n = len(text.encode().split()) + 1
                for k, begin in enumerate(range(0, n, longest)):
                    ids.append(doc)
                    number.append(k)
                    start.append(begin)
                    length.append(min(longest, n - begin))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 *[pa.array(c, pa.int32()) for c in (number, start, length)]],
                ["doc_id", "piece", "start", "length"])

        return step

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty())
    return map_batches(rows, make, "doc_id long, piece int, start int, length int")


def pack_documents(docs: DataFrame, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """One row per bin: ``bin_id``, its ``capacity``, ``n_tokens``, ``n_pieces`` and ``pieces``.

    Every piece of every row is in exactly one bin, repeated rows included. Shards hold
    SHARD_PIECES pieces at most on average, dealt evenly, whatever ids they carry.
    """
    prepare(docs.sparkSession)
    lengths = tuple(sorted(lengths))
    pieces = stored(document_pieces(docs, lengths[-1]), "pieces")
    shards = max(1, -(-pieces.count() // SHARD_PIECES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["piece"]))
        bins = pack([r["length"] for r in rows], lengths)
        kind = pa.list_(pa.struct([
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int32()),
            ("length", pa.int32())]))
        held = [[rows[i] for i in members] for _, members in bins]
        yield pa.RecordBatch.from_arrays([
            pa.array([length for length, _ in bins], pa.int32()),
            pa.array([sum(r["length"] for r in h) for h in held], pa.int32()),
            pa.array([len(h) for h in held], pa.int32()), pa.array(held, kind),
        ], ["capacity", "n_tokens", "n_pieces", "pieces"])

    packed = pieces.repartition(shards).mapInArrow(run, BINS)
    return packed.select(F.monotonically_increasing_id().alias("bin_id"), "*")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences."""
    return pack_documents(table(spark, folder, "documents"))
