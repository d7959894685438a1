"""Writers: fixed column tables, JSON Lines, split lists, checksum lists, write-once versions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.manifest import SPLITS, ordered_union

# Training lists take over the smoke splits.
LIST_SPLITS = {
    "smoke_train": ("smoke_train",), "smoke_benchmark": ("smoke_benchmark",), "train": ("smoke_train", "train"),
    "validation": ("validation",), "benchmark": ("smoke_benchmark", "benchmark"),
}


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_csv(rows: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    """Fixed column order; missing columns are empty, other columns are left out."""
    have = set(rows.columns)
    rows.select(*[(F.col(c) if c in have else F.lit("")).cast("string").alias(c) for c in columns]).write.option("header", True).option(
        "escape", '"'
    ).mode(mode).csv(path)


def write_jsonl(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line with keys in name order."""
    rows.select(*sorted(rows.columns)).write.mode(mode).option("ignoreNullFields", False).json(path)


def list_lines(rows: DataFrame, audio_root: str, speaker: str, language: str = "JA"):
    """``list, id, line`` for every list a row belongs to, and the rows a list cannot hold.

    A list line is ``path|speaker|language|text``, so text must not contain a bar.
    """
    text = F.coalesce("text", F.lit(""))
    reason = F.when((F.col("language") != language) | F.col("language").isNull() | (text == ""), "TEXT_LANGUAGE").when(F.contains(text, F.lit("|")), "TEXT_CONTAINS_PIPE")
    member = F.explode(F.array_compact(F.array(*[F.when(F.col("split").isin(*s), F.lit(n)) for n, s in LIST_SPLITS.items()])))
    marked = rows.withColumn("__reason", reason).withColumn("list", member)
    line = F.concat_ws("|", F.concat(F.lit(audio_root.rstrip("/") + "/"), F.col("audio_relpath")), F.lit(speaker), "language", "text")
    good = marked.where("__reason is null").select("list", "id", line.alias("line"))
    return good, marked.where("__reason is not null").select("list", "id", F.col("__reason").alias("reason"))


def write_lists(listed: DataFrame, path: str, order: str = "id", mode: str = "errorifexists") -> None:
    """One folder per list; lines are sorted inside their files by range partitioning."""
    listed.repartitionByRange("list", order).sortWithinPartitions("list", order).select("list", F.col("line").alias("value")).write.mode(mode).partitionBy("list").text(path)


def path_lists(rows: DataFrame, path: Column | str = "audio_relpath") -> DataFrame:
    """``list, path`` of accepted rows per split."""
    return rows.where((F.col("status") == "accepted") & F.col("split").isin(*SPLITS)).select(F.col("split").alias("list"), F.col(path).alias("path") if isinstance(path, str) else path.alias("path"))


def write_mixed_list(lists: Sequence[DataFrame], path: str, value: str, position: str, parts: int | None = None, mode: str = "errorifexists") -> None:
    """All lists in one, each value where it first appears; null and empty values are left out.

    The order spans the files: range partitions are written as numbered parts, never by one task.
    """
    named = ordered_union([rows.where(F.col(value) != "") for rows in lists], value, position)
    count = () if parts is None else (parts,)
    named.repartitionByRange(*count, "first").sortWithinPartitions("first").select(F.col(value).alias("value")).write.mode(mode).text(path)


def checksum_lines(members: DataFrame) -> DataFrame:
    """``sha256  path`` lines; write them with ``write_sorted``."""
    return members.select("path", F.concat_ws("  ", "sha256", "path").alias("value"))


def write_sorted(rows: DataFrame, path: str, order: str, mode: str = "errorifexists") -> None:
    """Text output whose part files, read in name order, are globally sorted."""
    rows.orderBy(order).select("value").write.mode(mode).text(path)


def write_accepted_rejected(tagged: DataFrame, reason: str, accepted: str, rejected: str) -> None:
    """Rows without a reason and rows with one, side by side."""
    tagged = tagged.persist(StorageLevel.DISK_ONLY)  # both writes read the rows that one run made
    tagged.where(F.col(reason).isNull()).drop(reason).write.mode("errorifexists").parquet(accepted)
    tagged.where(F.col(reason).isNotNull()).write.mode("errorifexists").parquet(rejected)
    tagged.unpersist()


def publish(tables: dict[str, DataFrame], target: str, checks: DataFrame | None = None, dry_run: bool = False) -> dict:
    """Write a version once: refuse an existing target, stage, check, then one rename.

    ``checks`` is a check table (code, failures, passed); any failed check keeps the staged
    data out of the target. A dry run refuses and checks the same way and writes nothing.
    """
    if not tables:
        raise ValueError("nothing to publish")
    spark = next(iter(tables.values())).sparkSession
    final, fs = _path(spark, target)
    if fs.exists(final):
        raise FileExistsError(f"target exists: {target}")
    failed = [r["code"] for r in checks.where("not passed").select("code").collect()] if checks is not None else []
    if failed or dry_run:
        return {"status": "BLOCKED" if failed else "DRY_RUN_PASS", "failed": failed, "target": target}
    stage = f"{target.rstrip('/')}.{uuid.uuid4().hex}.staging"
    staged, _ = _path(spark, stage)
    for name, rows in tables.items():
        rows.write.mode("errorifexists").parquet(f"{stage}/{name}")
    if fs.exists(final) or not fs.rename(staged, final):
        raise FileExistsError(f"target appeared while writing: {target}")
    return {"status": "PUBLISHED", "failed": [], "target": target}
