"""SimHash fingerprints and exact Hamming links through sharded vantage-point trees.

Fingerprint: lower-case A-Z, words are runs of bytes without ASCII white space, shingles of
``width`` words joined by a blank (repeats count), XXH64 with seed 42 of each; a bit is set
if it is set in over half the hashes. Fewer words make one shingle, no word gives zero.

Links: two fingerprints at most ``radius`` bits apart. The 64 bits are cut into ``BANDS``
bands; such a pair differs by at most ``radius // BANDS`` bits in some band. Per band a
vantage-point tree over Hamming distance inside the band cuts all fingerprints into shards:
a node sends distances up to its border to the inner branch, the others outside. Every
fingerprint has one home shard and, by the triangle inequality, visits exactly the shards
whose members can lie within the band's radius; all other branches are pruned. Inside a shard the tree goes
on in memory down to small leaves, where home members meet visitors on all 64 bits. The
result is exact for any tree.

Sizes: only distinct fingerprints enter, so copies cost nothing. The upper tree is fitted on
at most ``SAMPLE`` fingerprints (8 bytes each) and decides speed alone. Copies per
fingerprint grow by about a third per level and band. A shard emits a spanning forest, at
most one link per member, never all pairs of a group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, components, keep_rows, sha256_of, table, text_rows

WIDTH = 4
RADIUS = 4
BANDS = 3
SAMPLE = 1 << 17
SHARD_ROWS = 8192
LEAF = 64
BLOCK = 1 << 15


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_in = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), BLOCK):
        hashes = np.array([xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts[k : k + BLOCK].tolist(), ends[k : k + BLOCK].tolist())], dtype="<u8")
        set_in += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_in > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, fp`` (a signed 64-bit integer) and ``digest`` (SHA-256 of the text) of every row."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            made = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64)
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64)), digests], ["doc_id", "fp", "digest"])

    rows = text_rows(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long, digest binary")


def _band_masks() -> list[np.uint64]:
    cuts = [round(64 * k / BANDS) for k in range(BANDS + 1)]
    return [np.uint64(((1 << (b - a)) - 1) << a) for a, b in zip(cuts, cuts[1:])]


def _distance(values: np.ndarray, vantage, mask) -> np.ndarray:
    return np.bitwise_count((values ^ vantage) & mask).astype(np.int16)


def _border(values: np.ndarray, mask, rng) -> tuple[np.uint64, int] | None:
    """A vantage point and the border that halves ``values`` best; None if nothing splits."""
    best = None
    for vantage in values[rng.integers(0, len(values), 4)]:
        counts = np.bincount(_distance(values, vantage, mask), minlength=65)
        inner = np.cumsum(counts)
        off = np.abs(inner - len(values) / 2)
        off[inner == len(values)] = np.inf
        r = int(off.argmin())
        if np.isfinite(off[r]) and (best is None or off[r] < best[0]):
            best = (off[r], vantage, r)
    return best and best[1:]


def fit_tree(sample: np.ndarray, band: int, depth: int) -> list:
    """Upper tree of a band as nested lists ``[vantage, border, inner, outer]``; leaves are numbers."""
    mask, rng, leaves = _band_masks()[band], np.random.default_rng(band), [0]

    def build(values: np.ndarray, left: int):
        cut = _border(values, mask, rng) if left and len(values) > 8 else None
        if cut is None:
            leaves[0] += 1
            return leaves[0] - 1
        vantage, r = cut
        inside = _distance(values, vantage, mask) <= r
        return [int(vantage), r, build(values[inside], left - 1), build(values[~inside], left - 1)]

    return build(sample, depth)


def _route(values: np.ndarray, tree, mask, slack: int):
    """Yields ``(leaf, rows, home)`` for the shards that each value visits."""
    stack = [(tree, np.arange(len(values)), np.ones(len(values), dtype=bool))]
    while stack:
        node, rows, home = stack.pop()
        if not isinstance(node, list):
            yield node, rows, home
            continue
        vantage, r, inner, outer = node
        d = _distance(values[rows], np.uint64(vantage), mask)
        for branch, goes, own in ((inner, d <= r + slack, d <= r), (outer, d > r - slack, d > r)):
            if goes.any():
                stack.append((branch, rows[goes], (home & own)[goes]))


class _Forest:
    """Union-find over positions of an array."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        top = self.parent[at]
        while True:
            up = self.parent[top]
            if (up == top).all():
                self.parent[at] = top
                return top
            top = up

    def join(self, at: np.ndarray) -> None:
        roots = self.roots(at)
        self.parent[roots] = roots.min()


def shard_links(values: np.ndarray, home: np.ndarray, band: int, radius: int) -> np.ndarray:
    """Spanning forest of the pairs (home member, any member) within ``radius``; two columns."""
    mask, slack, forest = _band_masks()[band], radius // BANDS, _Forest(len(values))
    rng = np.random.default_rng(len(values))
    stack = [(np.flatnonzero(home), np.arange(len(values)))]
    while stack:
        own, visitors = stack.pop()
        cut = _border(values[own], mask, rng) if len(own) > LEAF else None
        if cut is not None:
            vantage, r = cut
            d, e = _distance(values[own], vantage, mask), _distance(values[visitors], vantage, mask)
            stack += [(own[d <= r], visitors[e <= r + slack]), (own[d > r], visitors[e > r - slack])]
            continue
        seen = values[visitors]
        for k in range(0, len(own), LEAF):
            block = own[k : k + LEAF]
            near = np.bitwise_count(values[block][:, None] ^ seen[None, :]) <= radius
            for i in np.flatnonzero(near.sum(axis=1) > 1):
                forest.join(visitors[near[i]])
    roots = forest.roots(np.arange(len(values)))
    linked = roots != np.arange(len(values))
    return np.stack([values[linked], values[roots[linked]]], axis=1)


def hamming_links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that connect distinct ``fp`` values as all pairs within ``radius`` do."""
    points = checkpointed(points.select("fp").filter("fp is not null").distinct())
    n = points.count()
    # Hash order is random for fingerprints, so the first rows by a hash are a fair sample.
    share = min(1.0, SAMPLE / max(n, 1))
    drawn = points.filter(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(SAMPLE).toPandas()["fp"]
    sample = np.sort(drawn.to_numpy(dtype=np.int64)).view(np.uint64)
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / SHARD_ROWS))))
    trees, masks, slack = [fit_tree(sample, b, depth) for b in range(BANDS)], _band_masks(), radius // BANDS

    def deal(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for band, (tree, mask) in enumerate(zip(trees, masks)):
                found = list(_route(values, tree, mask, slack))
                rows = np.concatenate([r for _, r, _ in found]) if found else np.zeros(0, dtype=np.int64)
                for k in range(0, len(rows), 1 << 16):
                    cut = slice(k, k + (1 << 16))
                    leaf = np.concatenate([np.full(len(r), x, dtype=np.int32) for x, r, _ in found])[cut]
                    home = np.concatenate([h for _, _, h in found])[cut]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaf), band, dtype=np.int32)), pa.array(leaf), pa.array(values[rows[cut]].view(np.int64)), pa.array(home)], ["band", "leaf", "fp", "home"])

    def link(key, frame):
        pairs = shard_links(frame["fp"].to_numpy().view(np.uint64), frame["home"].to_numpy(), int(key[0]), radius)
        return pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})

    shards = points.mapInArrow(deal, "band int, leaf int, fp long, home boolean")
    return shards.groupBy("band", "leaf").applyInPandas(link, "a long, b long")


def near_groups(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id, digest`` per row; the smallest doc_id names a component.

    Empty and null texts share fingerprint zero, which links like any other. Null doc_ids
    keep their row and never name a component that has another id; repeated rows repeat.
    Empty tables give no rows; columns besides doc_id and text are ignored. ``digest`` is
    the SHA-256 of the text.
    """
    rows = checkpointed(fingerprints(docs, width))
    firsts = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(hamming_links(firsts, radius)).select(F.col("node").alias("fp"), "root")
    rooted = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "digest")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of every group, with all its columns.

    Groups without any doc_id have no name: of each of their fingerprints one row stays.
    """
    found = checkpointed(near_groups(docs))
    best = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("alone")).agg(F.min("digest").alias("best"))
    mine = F.col("f.component_id").eqNullSafe(F.col("b.component_id")) & F.when(F.col("f.component_id").isNull(), F.col("f.fingerprint")).eqNullSafe(F.col("b.alone"))
    judged = found.alias("f").join(best.alias("b"), mine).select("f.doc_id", "f.digest", (F.col("f.doc_id").eqNullSafe(F.col("f.component_id")) & (F.col("f.digest") == F.col("b.best"))).alias("kept"))
    return keep_rows(docs, sha256_of(docs["text"]), judged)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("digest")
