"""Packing token ids into sequences of bounded length, with a fixed number of open windows.

Each partition packs its documents as they come. A document longer than a sequence first gives off full sequences; what
remains is placed into the open window it fits best (least room left). When it fits none, the fullest window is emitted and a new one
opened, so a task holds ``open_windows`` sequences at most. Windows still open when their partitions end are merged as whole
windows, largest first, in tasks that see a bounded number of them. Only these leftovers are shuffled.

A sequence is padded to full length, unless its length is a power of two (shapes that kernels are compiled for as well).
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import stored
from airlake.llm.tokens import encoder, id_list

LENGTH = 2048
OPEN_WINDOWS = 256
MERGED_AT_ONCE = 20_000  # windows one merging task holds (as numbers, without ids)
FULL_ENOUGH = 16  # ids of padding at which a window is emitted at once

PIECES = "doc_id bigint, start bigint, doc_tokens bigint, part bigint, window bigint, offset bigint, closed boolean, ids array<int>"


class OpenWindows:
    """A fixed number of open windows: best fit, or else the fullest one goes."""

    def __init__(self, length: int, limit: int):
        self.length, self.limit, self.count = length, limit, 0
        self.rooms: list[tuple[int, int]] = []  # (room left, window), ascending
        self.held: dict[int, list] = {}

    def put(self, size: int, piece) -> list[tuple[int, list]]:
        """Place one piece of at most ``length`` ids; returns the windows emitted by that: (window, [(offset, piece)])."""
        out = []
        at = bisect_left(self.rooms, (size, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) == self.limit:
                out.append(self.take(0))
            room, window = self.length, self.count
            self.count += 1
            self.held[window] = []
        self.held[window].append((self.length - room, piece))
        insort(self.rooms, (room - size, window))
        if room - size <= FULL_ENOUGH:
            out.append(self.take(bisect_left(self.rooms, (room - size, window))))
        return out

    def take(self, at: int) -> tuple[int, list]:
        window = self.rooms.pop(at)[1]
        return window, self.held.pop(window)


def packed_pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int, open_windows: int) -> DataFrame:
    """PIECES of all documents; ``closed`` is false for windows that were open when their partition ended."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, windows = encoder(tokenizer).encode_all, OpenWindows(length, open_windows)
        rows: list[tuple] = []

        def add(window: int, pieces: list, closed: bool, part: int) -> None:
            for offset, (doc_id, start, total, ids) in pieces:
                rows.append((doc_id, start, total, part, window, offset, closed, ids))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 6 + [pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)] + [id_list(list(columns[7]))]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PIECES.split(", ")])

        part = 0
        for batch in batches:
            parts, doc_ids = (batch.column(n).to_pylist() for n in ("part", "doc_id"))
            for part, doc_id, ids in zip(parts, doc_ids, encode_all(batch.column("text")), strict=True):  # noqa: B007
                ids += end
                total = len(ids) // 4
                for start in range(0, total, length):
                    size = min(length, total - start)
                    piece = (doc_id, start, total, ids[4 * start : 4 * (start + size)])
                    for window, pieces in windows.put(size, piece):
                        add(window, pieces, True, part)
                if len(rows) >= 1024:
                    yield flush()
        while windows.rooms:
            window, pieces = windows.take(0)
            add(window, pieces, False, part)
        if rows:
            yield flush()

    rows = docs.select(
        F.spark_partition_id().cast("long").alias("part"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return rows.mapInArrow(run, PIECES)


def merge_windows(windows: DataFrame, length: int, tasks: int) -> DataFrame:
    """(part, window, to_part, to_window, base): best fit, largest windows first, within each of ``tasks`` tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rooms: list[tuple[int, int]] = []
        n = 0
        for frame in frames:
            to, base = [], []
            for size in frame["size"]:
                at = bisect_left(rooms, (size, -1))
                if at < len(rooms):
                    room, window = rooms.pop(at)
                else:
                    room, window, n = length, n, n + 1
                to.append(window)
                base.append(length - room)
                insort(rooms, (room - size, window))
            yield frame[["part", "window", "to_part"]].assign(to_window=np.int64(to), base=np.int64(base))

    dealt = windows.repartition(tasks, "part", "window").sortWithinPartitions(F.desc("size"), "part", "window")
    dealt = dealt.withColumn("to_part", F.spark_partition_id().cast("long"))
    return dealt.select("part", "window", "to_part", "size").mapInPandas(
        run, "part bigint, window bigint, to_part bigint, to_window bigint, base bigint"
    )


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, open_windows: int = OPEN_WINDOWS
) -> DataFrame:
    """doc_id, start, ids, doc_tokens, sequence_id, offset: one row per piece; every id lies in exactly one.

    Null and empty texts are a lone ``end_id``; null doc_ids and repeated rows are packed like others. An empty table has no
    pieces. Other columns are ignored.
    """
    pieces = stored(packed_pieces(docs, tokenizer, end_id, length, open_windows), "packed-pieces")
    done = pieces.where("closed").select(
        "doc_id", "start", "ids", "doc_tokens",
        F.shiftleft("part", 32).bitwiseOR(F.col("window")).alias("sequence_id"), "offset",
    )
    left = pieces.where("not closed")
    windows = left.groupBy("part", "window").agg(F.max(F.col("offset") + F.size("ids")).alias("size"))
    tasks = max(1, -(-windows.count() // MERGED_AT_ONCE))
    to = stored(merge_windows(windows, length, tasks), "merged-windows")
    merged = left.join(to, ["part", "window"])
    last = merged.select(
        "doc_id", "start", "ids", "doc_tokens",
        # the sign bit of the part number keeps these apart from the sequences closed before
        F.shiftleft(F.col("to_part") + F.lit(1 << 30), 32).bitwiseOR(F.col("to_window")).alias("sequence_id"),
        (F.col("base") + F.col("offset")).alias("offset"),
    )
    return done.unionByName(last)


def padded_length(filled: Column, length: int = LENGTH) -> Column:
    """What a sequence of ``filled`` ids takes: itself at a power of two, else the full length."""
    return F.when(F.bit_count(filled) == 1, filled).otherwise(F.lit(length))


def sequences(pieces: DataFrame, pad_id: int = 0, length: int = LENGTH) -> DataFrame:
    """sequence_id, ids (padded), doc_starts (offsets at which a piece begins): at most ``length`` pieces meet in one."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.flatten("parts.ids")
    return joined.select(
        "sequence_id",
        F.concat(ids, F.array_repeat(F.lit(pad_id), (padded_length(F.size(ids), length) - F.size(ids)).cast("int"))).alias("ids"),
        F.col("parts.offset").alias("doc_starts"),
    )
