"""Bounded-space online packing of token ids into sequences of one length.

Each task reads its documents in order and keeps at most ``windows`` open windows. What fills
a window whole is a sequence at once; the rest of a document goes to the open window that it
fits best. Where none has room the fullest is emitted: the document's head fills it up, if
at least ``least`` ids fit, and the rest looks for a window again. So a task holds a fixed
number of ids whatever its input, no text is shuffled, and documents are cut only where a
window would else be padded.

Windows left open at the end of a task are the leftovers, at most ``windows`` a task. Their
pieces, with their ids, are laid in one global row by a distributed running sum (window by
window) and cut at every full length; only the last sequence of all stays short.

A null or empty text is a document of the end id alone. Null and repeated doc_ids are rows
like any other; equal rows are packed beside each other in some order; an empty table gives
no pieces; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, numbered, table, text_rows
from .token_files import token_lists, vocabulary_file

LENGTH, WINDOWS, LEAST, END_ID = 2048, 64, 8, 1
#: Sequences that are made of leftovers are numbered from here; task t numbers from t * 2 ** 32.
MERGED = 1 << 60
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset", "sequence_tokens", "ids"]
PIECE_TYPE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, sequence_tokens long, ids binary"


class OpenWindows:
    """The open windows of one task. Pieces are ``(doc_id, start, ids, doc_tokens)``."""

    def __init__(self, length: int, windows: int, least: int):
        self.length, self.windows, self.least = length, windows, least
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.held: dict[int, list] = {}
        self.made = 0

    def add(self, doc_id: int | None, ids: np.ndarray):
        """Place a document; yields the windows ``(number, pieces)`` that it closes."""
        n, start, length = len(ids), 0, self.length
        while n - start >= length:
            yield self._number(), [(doc_id, start, ids[start : start + length], n)]
            start += length
        while start < n:
            left = n - start
            k = bisect_left(self.rooms, (left, -1))
            if k < len(self.rooms):
                room, window = self.rooms.pop(k)
            elif len(self.rooms) < self.windows:
                room, window = length, self._number()
                self.held[window] = []
            else:
                room, window = self.rooms.pop(0)  # the fullest, with too little room
                left = room if room >= self.least else 0
            if left:
                self.held[window].append((doc_id, start, ids[start : start + left].copy(), n))
                start += left
            if left == room or left == 0:
                yield window, self.held.pop(window)
            else:
                insort(self.rooms, (room - left, window))

    def _number(self) -> int:
        self.made += 1
        return self.made - 1


def _rows(windows, base: int, keep_ids: bool) -> pa.RecordBatch:
    rows = []
    for window, pieces in windows:
        offset, total = 0, sum(len(p[2]) for p in pieces)
        for doc_id, start, ids, n in pieces:
            raw = ids.astype("<u4").tobytes()
            rows.append((doc_id, start, len(ids), zlib.crc32(raw), n, base + window, offset, total, raw if keep_ids else None))
            offset += len(ids)
    kinds = [pa.int64()] * 8 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], PIECE)


def placed(docs: DataFrame, path: str | None = None, length: int = LENGTH, windows: int = WINDOWS, least: int = LEAST, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of closed windows, and, with their ids and no ``sequence_tokens``, those of the leftovers."""
    path = path or vocabulary_file()

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        state = OpenWindows(length, windows, least)
        for batch in batches:
            for first, at, flat in token_lists(batch.column("text"), path):
                closed = []
                for k, doc_id in enumerate(batch.column("doc_id").slice(first, len(at) - 1).to_pylist()):
                    closed += state.add(doc_id, np.append(flat[at[k] : at[k + 1]], np.uint32(end_id)))
                    if len(closed) > 4 * windows:
                        yield _rows(closed, base, keep_ids)
                        closed = []
                if closed:
                    yield _rows(closed, base, keep_ids)
        if state.held:
            left = _rows(state.held.items(), base, True)
            yield left.set_column(7, "sequence_tokens", pa.nulls(left.num_rows, pa.int64()))

    return text_rows(docs).mapInArrow(run, PIECE_TYPE)


def merged(left: DataFrame, length: int, keep_ids: bool) -> DataFrame:
    """Leftover pieces laid one after the other and cut at every ``length`` ids."""
    row = numbered(left.drop("sequence_tokens"), ["window", "offset"], "place", total="length")
    total = row.agg(F.max(F.col("place") + F.col("length"))).first()[0]
    if total is None:
        return left.filter("false")
    first, last = F.expr(f"place div {length}"), F.expr(f"(place + length - 1) div {length}")
    cut = row.withColumn("sequence", F.explode(F.sequence(first, last)))
    begin, end = F.greatest("place", F.col("sequence") * length), F.least(F.col("place") + F.col("length"), (F.col("sequence") + 1) * length)
    cut = cut.withColumns({"skip": begin - F.col("place"), "take": end - begin, "offset": begin - F.col("sequence") * length})
    ids = F.col("ids").substr((4 * F.col("skip") + 1).cast("int"), (4 * F.col("take")).cast("int"))
    return cut.select(
        "doc_id", (F.col("start") + F.col("skip")).alias("start"), F.col("take").alias("length"), F.crc32(ids).alias("ids_crc32"), "doc_tokens",
        (F.col("sequence") + MERGED).alias("window"), "offset",
        F.least(F.lit(length), F.lit(total) - F.col("sequence") * length).cast("long").alias("sequence_tokens"), (ids if keep_ids else F.lit(None).cast("binary")).alias("ids"),
    )


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, windows: int = WINDOWS, least: int = LEAST, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, ids``.

    Every id of every document (its end id last) is in exactly one piece; the pieces of a
    sequence lie gapless from offset 0. ``ids`` are little-endian 32-bit integers, null
    without ``keep_ids``.
    """
    # Written once: closed windows and leftovers come from the same run of each task.
    made = checkpointed(placed(docs, path, length, windows, least, end_id, keep_ids))
    closed = made.filter("sequence_tokens is not null")
    rows = closed.unionByName(merged(made.filter("sequence_tokens is null"), length, keep_ids))
    return rows.withColumnRenamed("window", "sequence_id")


def padded_length(tokens: Column, length: int = LENGTH) -> Column:
    """What a sequence of ``tokens`` ids is stored as: its own length if a power of two, else ``length``."""
    return F.when(F.bit_count(tokens) == 1, tokens).otherwise(F.lit(length)).cast("long")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, doc_ids, lengths, ids`` of pieces packed with ``keep_ids``; ``ids`` unpadded bytes."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", F.hex("ids").alias("ids"))))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("p"))
    return rows.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"), F.unhex(F.concat_ws("", "p.ids")).alias("ids"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.drop("ids").withColumn("padded_length", padded_length(F.col("sequence_tokens")))
