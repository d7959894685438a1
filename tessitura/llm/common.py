"""Shared pieces: table reading, staged intermediate rows, global numbering, components.

Intermediate rows are cut with ``checkpoint()``, whose files lie in the folder that
``spark.checkpoint.dir`` names, so a lost executor never takes the only copy along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessitura.session import ensure_checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame) -> DataFrame:
    """The two columns that every operator needs, null texts as empty ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder, with their lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from every fit: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sha256_of(text: Column) -> Column:
    """SHA-256 of a text column's UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def keep_rows(docs: DataFrame, digest: Column, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``verdicts`` (``doc_id, digest, kept``, a row per row) keep.

    Rows are known by doc_id (null equals null) and ``digest``. What is dropped is taken
    away by an anti join, which Spark broadcasts only while it is small. Where rows share
    both, as many verdicts do; if one of them keeps, one such row is kept.
    """
    # Names that no column of ``docs`` has.
    key, one, other, often = (fresh_name(docs, n) for n in ("key", "id", "digest", "n"))
    judged = verdicts.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias(often))
    judged = checkpointed(judged.select(F.col("doc_id").alias(one), F.col("digest").alias(other), "kept", often))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(one)) & (F.col(key) == F.col(other))
    rows = docs.withColumn(key, digest)
    left = rows.join(judged.filter("not kept").select(one, other), same, "left_anti")
    repeated = judged.filter(F.col("kept") & (F.col(often) > 1)).select(one, other)
    if repeated.take(1):
        once = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", key])
        left = left.join(repeated, same, "left_anti").unionByName(once)
    return left.drop(key)


def fresh_name(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken, name = {c.lower() for c in df.columns}, f"_{label}"
    while name in taken:
        name = f"_{name}"
    return name


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[str], name: str = "number", total: str | None = None) -> DataFrame:
    """Number all rows from 0 in ``order``, or give each the sum of ``total`` before it.

    Rows are dealt into ranges of the whole order (with a tie-break, so equal keys may be
    split), one sum per range is carried forward, and a window runs inside each range.
    The carried table has one row per range. Nulls sort first; rows equal in all order
    columns are numbered in some order.
    """
    spark = df.sparkSession
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts(spark), *order, "_tie")
    ranged = checkpointed(ranged.withColumn("_range", F.spark_partition_id()))
    amount = F.col(total) if total else F.lit(1)
    sums = ranged.groupBy("_range").agg(F.sum(amount).cast("long").alias("_sum"))
    before = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order, "_tie")
    own = F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - amount
    return ranged.withColumn("_own", own).join(F.broadcast(before), "_range").withColumn(name, (F.col("_before") + F.col("_own")).cast("long")).drop("_tie", "_range", "_own", "_before")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of every node in ``edges``: columns ``node``, ``root``.

    Alternating large-star and small-star steps: every node keeps a bounded number of
    links to smaller nodes, so no step pairs the members of a group with each other. A
    hub's rows are aggregated before the shuffle (a minimum per node), then joined.
    Edges are checkpointed after each round; rounds grow with the logarithm of a chain.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = checkpointed(both.distinct())
    before = None
    while True:
        # Large star: each larger neighbour of a node moves to the node's smallest one.
        ways = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = ways.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours of a node move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        links = checkpointed(small.filter("u <> v").distinct())
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)
