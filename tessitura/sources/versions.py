"""Versions of a table published by manifest: no rename, safe on object stores.

Every publisher writes its files under a name of its own and then creates one small
manifest that must not exist yet. Whoever creates ``manifests/<n>.json`` first has published
version n; the files of the other are named by no manifest and nobody reads them. Rows are
built per key, and a key whose inputs have not changed since the last version is not built
again: the new manifest goes on naming its files. A run that is repeated after a loss
therefore does only what is missing.

Layout below the root: ``manifests/<n>.json``, ``data/<id>/rows`` (rows with their key,
input fingerprint and file set), ``data/<id>/index`` (one row per live key).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import _path

PRINT, SET = "input_fingerprint", "file_set"


def fingerprints(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, input_fingerprint``: equal for equal bags of rows, whatever their order.

    Row hashes are summed, which pre-aggregates, so a key with a third of all rows is no
    burden. Columns count by name, nulls and empty texts differ.
    """
    data = [F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.lit(1)) for c in sorted(rows.columns)]
    texts = [F.col(c) for c in sorted(rows.columns)]
    one, two = F.xxhash64(*data, *texts), F.xxhash64(F.lit(1), *texts, *data)
    total = lambda h: F.sum(h.cast("decimal(38,0)")).cast("string")
    return rows.groupBy(*keys).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), total(one), total(two)).alias(PRINT))


def changes(now: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, change`` of two tables of fingerprints: NEW, CHANGED, SAME or GONE."""
    old = before.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(PRINT).alias("__before"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    both = now.join(old, same, "full")
    kind = F.when(F.col("__before").isNull(), "NEW").when(F.col(PRINT).isNull(), "GONE")
    kind = kind.when(F.col(PRINT) == F.col("__before"), "SAME").otherwise("CHANGED")
    gone = F.col(PRINT).isNull()
    return both.select(*[F.when(gone, F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys], kind.alias("change"))


def _manifest(spark: SparkSession, root: str, version: int) -> str:
    return f"{root.rstrip('/')}/manifests/{version:08d}.json"


def latest(spark: SparkSession, root: str) -> int:
    """Number of the last published version, 0 when there is none."""
    folder, fs = _path(spark, f"{root.rstrip('/')}/manifests")
    if not fs.exists(folder):
        return 0
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def read_manifest(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(_manifest(spark, root, version)).collect()))


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that must not exist, whole or not at all."""
    target, fs = _path(spark, path)
    if fs.getUri().getScheme() == "file":
        # Hadoop's local file system looks and then creates; a link does both at once.
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, local)
        finally:
            os.unlink(draft)
        return
    try:
        out = fs.create(target, False)
    except Exception as exc:
        if fs.exists(target):
            raise FileExistsError(path) from exc
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()


def publish_changed(
    inputs: DataFrame, root: str, keys: Sequence[str], build: Callable[[DataFrame], DataFrame],
    version: int | None = None, checks: Callable[[DataFrame], DataFrame] | None = None,
) -> dict:
    """Publish ``build(inputs)`` as the version after the last one, or as ``version``.

    ``build`` gets the inputs of new and changed keys only and must keep the key columns; a
    row of its output may depend on rows of its own key alone. ``checks`` turns the rows just
    written into a check table (code, failures, passed); a failed check leaves no manifest.
    Raises FileExistsError when somebody else published that version first: nothing of theirs
    is touched, and running again publishes on top of it. Null keys are keys like any other.
    """
    spark, keys, root = inputs.sparkSession, list(keys), root.rstrip("/")
    clash = {PRINT, SET} & set(inputs.columns)
    if clash:
        raise ValueError(f"reserved columns: {sorted(clash)}")
    last = latest(spark, root)
    number = last + 1 if version is None else version
    if number <= last:
        raise FileExistsError(_manifest(spark, root, number))
    now = fingerprints(inputs, keys)
    own = uuid.uuid4().hex
    old = spark.read.parquet(read_manifest(spark, root, last)["index"]) if last else None
    here = f"{root}/data/{own}"
    if old is None:
        index = now.withColumn(SET, F.lit(own))
    else:
        known = old.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(PRINT).alias("__print"), F.col(SET).alias("__set"))
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col(PRINT) == F.col("__print")]
        index = now.join(known, same, "left").select(*keys, PRINT, F.coalesce("__set", F.lit(own)).alias(SET))
    index.write.mode("errorifexists").parquet(f"{here}/index")
    index = spark.read.parquet(f"{here}/index")
    todo = index.where(F.col(SET) == own).select(*[F.col(k).alias(f"__{k}") for k in keys])
    wanted = inputs.join(todo, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_semi")
    build(wanted).withColumn(SET, F.lit(own)).write.mode("errorifexists").parquet(f"{here}/rows")
    failed = []
    if checks is not None:
        failed = [r["code"] for r in checks(spark.read.parquet(f"{here}/rows").drop(SET)).where("not passed").select("code").collect()]
    if failed:
        return {"status": "BLOCKED", "failed": failed, "version": None, "built": 0}
    sets = sorted({own, *(r[SET] for r in index.select(SET).distinct().collect())})  # one per version still in use
    built = todo.count()
    text = {"version": number, "index": f"{here}/index", "rows": [f"{root}/data/{s}/rows" for s in sets], "keys": keys}
    _create(spark, _manifest(spark, root, number), json.dumps(text, sort_keys=True))
    return {"status": "PUBLISHED", "failed": [], "version": number, "built": built}


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Rows of a published version: of every live key the rows of the file set its index names."""
    number = latest(spark, root) if version is None else version
    if not number:
        raise FileNotFoundError(root)
    m = read_manifest(spark, root, number)
    index = spark.read.parquet(m["index"]).select(*[F.col(k).alias(f"__{k}") for k in m["keys"]], F.col(SET).alias("__set"))
    rows = spark.read.parquet(*m["rows"])
    live = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in m["keys"]] + [F.col(SET) == F.col("__set")]
    return rows.join(index, live, "left_semi").drop(SET)
