"""Exact dedup through a minimal perfect hash over the distinct digests of earlier documents.

Every text becomes the SHA-256 of its UTF-8 bytes after lower-casing A-Z only. An *index*
over earlier ("historical") documents holds one slot per distinct digest: the full digest,
the locator of the winner (its doc_id) and the number of copies. Slots are numbered
gaplessly: digests are dealt into parts of about ``PART_KEYS``, each part finds one small
*pilot* number per bucket so that all its digests land on different slots of the part
(hash and displace, load 1), and part offsets make the slots global. A lookup joins a
digest to its bucket's pilot, computes the one possible slot and compares the full digest
there byte by byte. Members of history join their slot's group; nonmembers group among
themselves.

Sizes: pilots take about a quarter of a row per digest, one part is about ``PART_KEYS`` rows
of one task, no text is shuffled, and copies are counted before the shuffle, so a digest
that a third of all rows share is one row in every grouping. The last join from rows to
groups has a hot key on its left side only, which adaptive skew joins split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, keep_rows, table, text_rows

PART_KEYS = 1024
BUCKETS = 256


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest`` of every row; null counts as the empty text.

    ``bytes.lower`` changes A-Z alone, whatever the other bytes are.
    """

    def run(batches):
        for batch in batches:
            made = [hashlib.sha256(t.lower()).digest() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "digest"])

    rows = text_rows(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest binary")


def distinct_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: ``digest, winner`` (largest doc_id) and ``n`` copies."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))


def _slots(halves: np.ndarray, pilots: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Slot inside the part for two 64-bit digest halves and a pilot, all as arrays."""
    with np.errstate(over="ignore"):
        x = halves[..., 0] ^ (halves[..., 1] + pilots.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return (x % sizes.astype(np.uint64)).astype(np.int64)


def _halves(values) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(v)[:16] for v in values), dtype="<u8").reshape(-1, 2)


def _find_pilots(frame: pd.DataFrame) -> pd.DataFrame:
    """Pilots of one part: buckets from the fullest on, the first pilot that fits wins."""
    halves, size = _halves(frame["digest"]), len(frame)
    buckets = frame.groupby("bucket").indices
    taken, found = np.zeros(size, dtype=bool), {}
    for bucket, rows in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
        start = 0
        while bucket not in found:
            tries = np.arange(start, start + 256, dtype=np.int64)
            slots = _slots(halves[rows][None, :, :], tries[:, None], np.full((1, 1), size))
            fits = ~taken[slots].any(axis=1)
            if len(rows) > 1:
                ordered = np.sort(slots, axis=1)
                fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if fits.any():
                k = int(fits.argmax())
                found[bucket] = int(tries[k])
                taken[slots[k]] = True
            start += 256
    return pd.DataFrame({"part": frame["part"].iloc[0], "bucket": list(found), "pilot": list(found.values()), "size": size}).astype({"part": "int64", "bucket": "int32", "pilot": "int64", "size": "int64"})


def _dealt(rows: DataFrame, n_parts: int) -> DataFrame:
    return rows.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(n_parts)).cast("long")).withColumn("bucket", F.pmod(F.xxhash64("digest", F.lit(7)), F.lit(BUCKETS)).cast("int"))


def _located(rows: DataFrame, functions: DataFrame, n_parts: int) -> DataFrame:
    """Rows with a pilot get the only slot their digest can have, as ``slot``."""
    joined = _dealt(rows, n_parts).join(functions, ["part", "bucket"])
    kept = [c for c in joined.columns if c not in ("part", "bucket", "pilot", "size", "before")]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                pilots, sizes, before = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pilot", "size", "before"))
                slots = before + _slots(_halves(batch.column("digest").to_pylist()), pilots, sizes)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(slots, pa.int64())], [*kept, "slot"])

    types = ", ".join(f"{c} {t}" for c, t in joined.select(*kept).dtypes)
    return joined.mapInArrow(run, f"{types}, slot long")


class Index:
    """A minimal perfect hash: ``functions`` (pilots), ``slots`` (digest, winner, n) and its size."""

    def __init__(self, functions: DataFrame, slots: DataFrame, n_parts: int, size: int):
        self.functions, self.slots, self.n_parts, self.size = functions, slots, n_parts, size

    def lookup(self, rows: DataFrame) -> DataFrame:
        """Rows whose digest equals the digest in their slot, with ``slot``, ``old_winner``, ``old_n``."""
        held = self.slots.select("slot", F.col("digest").alias("_held"), F.col("winner").alias("old_winner"), F.col("n").alias("old_n"))
        return _located(rows, self.functions, self.n_parts).join(held, "slot").filter("digest = _held").drop("_held")


def build_index(history: DataFrame) -> Index:
    """Index over ``digest, winner, n`` rows with distinct digests; an empty history is allowed."""
    history = checkpointed(history)
    size = history.count()
    n_parts = max(1, -(-size // PART_KEYS))
    found = _dealt(history.select("digest"), n_parts).groupBy("part").applyInPandas(_find_pilots, "part long, bucket int, pilot long, size long")
    found = checkpointed(found)
    # Offsets in two levels, so that no task sorts all parts.
    sizes = found.groupBy("part").agg(F.first("size").alias("size")).withColumn("block", F.floor(F.col("part") / 4096))
    blocks = sizes.groupBy("block").agg(F.sum("size").alias("sum"))
    blocks = blocks.select("block", (F.sum("sum").over(Window.orderBy("block")) - F.col("sum")).alias("block_before"))
    inside = Window.partitionBy("block").orderBy("part")
    before = sizes.join(blocks, "block").select("part", (F.col("block_before") + F.sum("size").over(inside) - F.col("size")).cast("long").alias("before"))
    functions = checkpointed(found.join(before, "part"))
    slots = checkpointed(_located(history, functions, n_parts))
    return Index(functions, slots, n_parts, size)


def exact_groups(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Groups of equal texts over an earlier and a later batch of documents.

    Returns one row per document of either batch: ``doc_id, keep_id, group_size, kept,
    text_sha256, slot`` (null for texts that the earlier batch lacks). Of equal texts the
    largest doc_id stays; if all are null, keep_id is null. Rows tied on doc_id and text
    share a keep_id and exactly one of them is kept. Empty tables give no rows; columns
    besides doc_id and text are ignored.
    """
    old, new = checkpointed(digests(earlier)), checkpointed(digests(later))
    index = build_index(distinct_digests(old))
    fresh = distinct_digests(new)
    known = index.lookup(fresh)
    member = known.select("slot", F.col("winner").alias("new_winner"), F.col("n").alias("new_n"))
    grown = index.slots.join(member, "slot", "left").select("digest", "slot", F.greatest("winner", "new_winner").alias("keep_id"), (F.col("n") + F.coalesce("new_n", F.lit(0))).alias("group_size"))
    strangers = fresh.join(index.slots.select("digest"), "digest", "left_anti").select("digest", F.lit(None).cast("long").alias("slot"), F.col("winner").alias("keep_id"), F.col("n").alias("group_size"))
    groups = grown.unionByName(strangers)
    rows = old.unionByName(new).withColumn("_copy", F.monotonically_increasing_id())
    rows = checkpointed(rows.join(groups, "digest").withColumn("_best", F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    # Almost always one row is the best one; only rows repeated with their id need a choice.
    first = rows.filter("_best").groupBy("digest").agg(F.min("_copy").alias("_first"))
    return rows.join(first, "digest").select("doc_id", "keep_id", "group_size", (F.col("_copy") == F.col("_first")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "slot")


def without_copies(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, with all its columns."""

    @F.pandas_udf("binary")
    def lowered(texts: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(t.encode().lower()).digest() for t in texts])

    found = exact_groups(*split_by_age(docs)).select("doc_id", F.unhex("text_sha256").alias("digest"), "kept")
    return keep_rows(docs, lowered(F.coalesce(F.col("text").cast("string"), F.lit(""))), found)


def split_by_age(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents up to the middle of the id range (nulls too) are history, the others come later."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = None if low is None else (int(low) + int(high)) // 2
    old = F.lit(True) if middle is None else F.coalesce(F.col("doc_id") <= middle, F.lit(True))
    return docs.filter(old), docs.filter(~old)


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Without ``slot``, which depends on the pilots and has no SQL form."""
    return exact_groups(*split_by_age(table(spark, sf_dir, "documents"))).drop("slot")


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
