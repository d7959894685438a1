"""Fingerprints of large member tables as hash trees, and their difference.

A member belongs to the bucket that the first digits of its path's hash name. The number
of digits follows from the number of members, so a bucket holds about ``BUCKET`` of them at
any size; above the buckets every node hashes its at most 16 children. Two trees of the
same depth are compared from the root: only children of nodes that differ are looked at,
and at the end only the members of buckets that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..session import ensure_checkpoint_dir

BUCKET = 64


def tree_depth(n: int, bucket: int = BUCKET) -> int:
    """Digits of a bucket's name: the least depth whose buckets hold ``bucket`` members on average."""
    depth = 0
    while n > bucket << 4 * depth:
        depth += 1
    return depth


def _members(rows: DataFrame, path: str, digest: str) -> DataFrame:
    """Distinct (path, digest) pairs with the hash that places them and the hash that is compared."""
    pairs = rows.select(F.col(path).alias("path"), F.col(digest).alias("digest")).distinct()
    line = F.concat(F.coalesce("path", F.lit("")), F.lit("\t"), F.coalesce("digest", F.lit("")))
    return pairs.withColumns({"place": F.sha2(F.coalesce("path", F.lit("")), 256), "entry": F.sha2(line, 256)})


def _node(parts: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(parts), "\n"), 256)


def hash_tree(rows: DataFrame, depth: int, path: str = "path", digest: str = "sha256") -> list[DataFrame]:
    """Nodes ``node, hash, members`` per level, the root (named by the empty text) first. Empty buckets have no node."""
    ensure_checkpoint_dir(rows.sparkSession)
    members = _members(rows, path, digest)
    bucket = members.groupBy(F.substring("place", 1, depth).alias("node"))
    levels = [bucket.agg(_node(F.collect_list("entry")).alias("hash"), F.count(F.lit(1)).alias("members")).checkpoint()]
    for k in range(depth - 1, -1, -1):
        child = F.concat(F.substring("node", k + 1, 1), F.lit(" "), F.col("hash"))
        above = levels[0].groupBy(F.substring("node", 1, k).alias("node")).agg(_node(F.collect_list(child)).alias("hash"), F.sum("members").alias("members"))
        levels.insert(0, above)
    return levels


def tree_fingerprint(rows: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """``fingerprint, members, depth`` of a table; no row for an empty one."""
    depth = tree_depth(rows.select(path, digest).distinct().count())
    return hash_tree(rows, depth, path, digest)[0].select(F.col("hash").alias("fingerprint"), "members", F.lit(depth).cast("bigint").alias("depth"))


def tree_diff(left: DataFrame, right: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """(path, digest) pairs of one side only: ``path, digest, state`` (REMOVED: left only, ADDED: right only)."""
    sizes = [rows.select(path, digest).distinct().count() for rows in (left, right)]
    depth = tree_depth(max(sizes))
    trees = [hash_tree(rows, depth, path, digest) for rows in (left, right)]
    wanted = None
    for k, (a, b) in enumerate(zip(*trees)):
        sides = [a.select("node", F.col("hash").alias("a")), b.select("node", F.col("hash").alias("b"))]
        if wanted is not None:
            parents = wanted.select(F.col("node").alias("__above"))
            sides = [s.join(parents, F.substring("node", 1, k - 1) == F.col("__above"), "left_semi") for s in sides]
        both = sides[0].join(sides[1], "node", "full_outer")
        wanted = both.where(~F.col("a").eqNullSafe(F.col("b"))).select("node")
    buckets = wanted.checkpoint()
    here = [_members(rows, path, digest).withColumn("node", F.substring("place", 1, depth)).join(buckets, "node", "left_semi").select("path", "digest") for rows in (left, right)]
    only = lambda x, y, state: x.exceptAll(y).withColumn("state", F.lit(state))
    return only(here[0], here[1], "REMOVED").unionByName(only(here[1], here[0], "ADDED"))


def record_fingerprint(*columns: str) -> Column:
    """Hash of a record's canonical JSON: equal settings give equal values whatever the column order."""
    return F.sha2(fn.canonical_json(*columns), 256)


def job_fingerprints(jobs: DataFrame, inputs: DataFrame, key: str, settings: list[str]) -> DataFrame:
    """``key, fingerprint, inputs`` of jobs: their settings and the contents of their inputs (key, path, sha256).

    Inputs of a job are hashed in buckets of their path's hash first, so a job with very
    many inputs fills no single row; jobs without inputs count too.
    """
    entry = F.sha2(F.concat_ws("\t", F.coalesce("path", F.lit("")), F.coalesce("sha256", F.lit(""))), 256)
    pairs = inputs.select(key, "path", "sha256").distinct().withColumn("__b", F.substring(F.sha2(F.coalesce("path", F.lit("")), 256), 1, 3))
    buckets = pairs.groupBy(key, "__b").agg(_node(F.collect_list(entry)).alias("h"), F.count(F.lit(1)).alias("n"))
    content = buckets.groupBy(key).agg(_node(F.collect_list(F.concat("__b", F.lit(" "), "h"))).alias("__content"), F.sum("n").alias("inputs"))
    rows = jobs.select(key, record_fingerprint(*settings).alias("__settings")).join(content, key, "left")
    whole = F.sha2(F.concat_ws("\n", "__settings", F.coalesce("__content", F.lit(""))), 256)
    return rows.select(key, whole.alias("fingerprint"), F.coalesce("inputs", F.lit(0)).cast("bigint").alias("inputs"))
