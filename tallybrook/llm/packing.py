"""Packing token pieces into windows of near-equal length by multiway differencing.

Documents are cut where they pass the capacity, into full pieces and one rest; the rests of one
document in sixteen, chosen by its id, are cut finely, so that each group has small pieces to level
its windows with. Full pieces fill a window each. The rests are dealt over groups of some hundred windows' worth of tokens, and each
group is split by Karmarkar and Karp's differencing: every rest starts as a partition of its own
(one window holds it, the others nothing); the two partitions with the largest imbalances are merged,
the fullest window of one with the emptiest of the other, until one partition is left. Where its
fullest window exceeds the capacity, the group is split again into more windows.

Defined results: a null or empty text is the closing id alone; a repeated row is packed again; an
empty table gives no pieces; other columns are ignored. A piece's ids are those of the whole text, so
a text of any length is never cut before it is tokenized.
"""

import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heapreplace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallybrook.llm.common import id_and_bytes, ship, stored

CAPACITY = 4096
GROUP_WINDOWS = 256
FINE_OF_16 = 1
FINE_PIECE = 128
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def piece_bounds(doc: int, size: int, width: int, fine: int) -> Iterator[tuple[int, int]]:
    rest = size - size % width
    yield from ((i, i + width) for i in range(0, rest, width))
    chosen = (doc * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 60 < FINE_OF_16
    step = fine if chosen else width
    yield from ((i, min(i + step, size)) for i in range(rest, size, step))


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 2,
    lowered_words: bool = True, keep_ids: bool = False,
) -> DataFrame:
    """The pieces of each text's ids with ``end_id`` behind them; ``keep_ids`` adds the ids themselves."""
    kinds = [pa.int64()] * 6 + [pa.list_(pa.int32())] * keep_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "spread"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallybrook.llm.tokens import text_ids

        ids_of, closing = text_ids(vocabulary, lowered_words), end_id.to_bytes(4, "little")
        at, width = TaskContext.get().partitionId() << 40, 4 * capacity
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = ids_of(body.as_py().decode("utf-8", "replace")) + closing
                for start, end in piece_bounds(doc or 0, len(data), width, 4 * min(FINE_PIECE, capacity)):
                    piece = data[start:end]
                    ids = [np.frombuffer(piece, dtype="<u4").astype(np.int32)] * keep_ids
                    rows.append((doc, start // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4, at, *ids))
                    at += 1
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    ship(docs.sparkSession)
    schema = f"{PIECES}, spread long" + ", ids array<int>" * keep_ids
    return id_and_bytes(docs).mapInArrow(cut, schema)


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each length, by merging the two most imbalanced partitions again and again."""
    if windows == 1 or len(lengths) == 1:
        return np.zeros(len(lengths), dtype=np.int64)
    n = len(lengths)
    loads = {i: None for i in range(n)}
    merged: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(x), i) for i, x in enumerate(lengths)]
    heapify(heap)

    def sums(i: int) -> np.ndarray:
        if (x := loads.pop(i)) is None:
            x = np.zeros(windows, dtype=np.int64)
            x[0] = lengths[i]
        return x

    while len(heap) > 1:
        _, a = heappop(heap)
        b = heap[0][1]
        total = sums(a) + sums(b)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order] - total[order[-1]]
        loads[n + len(merged)] = total
        heapreplace(heap, (-int(total[0]), n + len(merged)))
        merged.append((a, b, order))
    placed = {heap[0][1]: np.arange(windows)}
    for i in range(len(merged) - 1, -1, -1):
        a, b, order = merged[i]
        slots = np.empty(windows, dtype=np.int64)
        slots[order] = placed.pop(n + i)
        placed[a], placed[b] = slots, slots[::-1]
    return np.array([placed[i][0] for i in range(n)], dtype=np.int64)


def windows_of(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Windows that hold at most ``capacity``; their number starts at the least and rises."""
    count = max(1, -(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))
    while True:
        chosen = differencing(lengths, count)
        if np.bincount(chosen, weights=lengths).max() <= capacity:
            return chosen
        count += 1


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """``pieces`` (stored, with ``spread``) with the sequence and the offset of each."""
    tokens = pieces.agg(F.sum("length").alias("n")).first()["n"] or 0
    groups = max(1, round(tokens / (capacity * group_windows)))
    extra = ["ids"] * ("ids" in pieces.columns)

    def place(group: pa.Table) -> pa.Table:
        lengths, ids, starts = (group.column(c).to_numpy() for c in ("length", "doc_id", "start"))
        order = np.lexsort((starts, ids, -lengths))
        group, lengths = group.take(pa.array(order)), lengths[order]
        full = int((lengths == capacity).sum())
        window = np.arange(len(lengths))
        if full < len(lengths):
            window[full:] = full + windows_of(lengths[full:], capacity)
        turn = np.argsort(window, kind="stable")
        before = np.cumsum(lengths[turn]) - lengths[turn]
        first = np.flatnonzero(np.r_[True, window[turn][1:] != window[turn][:-1]])
        offset = np.empty(len(turn), dtype=np.int64)
        offset[turn] = before - np.repeat(before[first], np.diff(np.r_[first, len(turn)]))
        sequence = (group.column("group").to_numpy() << 32) + window
        kept = group.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens", *extra])
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("spread"), F.lit(groups)).cast("long")).drop("spread")
    schema = f"{PIECES}" + ", ids array<int>" * len(extra) + ", sequence_id long, offset long"
    return dealt.groupBy("group").applyInArrow(place, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 2,
    lowered_words: bool = True, keep_ids: bool = False, group_windows: int = GROUP_WINDOWS,
) -> DataFrame:
    pieces = token_pieces(docs, vocabulary, capacity, end_id, lowered_words, keep_ids)
    return pack(stored(pieces, "pieces"), capacity, group_windows)
