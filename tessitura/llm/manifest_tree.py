"""Merkle manifest of a dataset: a content-addressed graph of nodes, and proofs by descent.

Every row is a leaf. Leaves of one source, in doc_id order, are taken in runs of 16 whose
digest is their parent, until one node is left, the source's subroot; subroots, ordered by
source, form the tree above them in the same way. What is stored is a table of records
``tree, height, digest, children``: a node's digest leads to its children's digests.

A proof descends from the root. All requested leaves below a node descend together: at each
height one row per node still wanted is joined with the records by digest, the digit of the
rank picks a child, and the other children join the path as a segment ``before, after``.
The segments of a path are reversed at the end, so they run from the leaf to the root.

Only the digests of a row are ever shuffled, never its text. Ranks come from ranges of
``(source, doc_id, leaf)``, so a source with a third of all rows is dealt over many tasks;
runs hold 16 rows, and a node's path is carried once for all leaves below it. Counts per
(range, source) and one digest, the root, are the only small tables.

Nulls are values of their own (written ``-``) and sort first; rows that share a source and a
doc_id are ordered by leaf digest, and equal rows are leaves beside each other; an empty
table has no root and no proofs; other columns are ignored.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, numbered, parts, shared_folder, table

FANOUT = 16
FIELDS = (("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENT = "struct<before:string,after:string>"


def joined_hash(digests: Column) -> Column:
    """Digest of an array of hex digests, joined."""
    return F.sha2(F.concat_ws("", digests), 256)


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row: each field as its UTF-8 length, a colon and its value, or ``-`` for null."""

    def field(name: str, kind: str) -> Column:
        text = F.coalesce(changed[name], F.lit(None)) if name in changed else F.col(name).cast(kind).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(name, kind) for name, kind in FIELDS]), 256)


def tampered_leaf() -> Column:
    """The digest a row shows: where 5 divides the crc32 of its doc_id, that of the text with A-Z lower-cased."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return F.when(chosen, leaf_digest(text=F.translate(F.col("text").cast("string"), UPPER, LOWER))).otherwise(F.col("leaf"))


@dataclasses.dataclass(frozen=True)
class Manifest:
    """Where the graph lies: ``records``, ``runs`` of leaves and ``sources`` as Parquet folders."""

    folder: str
    root: str | None
    height: int
    source_height: int

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{name}")

    def records(self, spark: SparkSession, tree: str, height: int) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/records/{tree}-{height}")


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``source, doc_id, leaf`` and more) with source number, rank in the source and source size: ``s, r, n``."""
    spark, order = leaves.sparkSession, ["_src", "doc_id", "leaf"]
    # Null sorts before the empty source, bytes decide otherwise.
    rows = checkpointed(leaves.withColumn("_src", F.coalesce(F.concat(F.lit("+"), "source"), F.lit(""))))
    rows = checkpointed(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts(spark), *order, "_tie").withColumn("_range", F.spark_partition_id()))
    counts = checkpointed(rows.groupBy("_range", "_src").agg(F.count(F.lit(1)).alias("c")))
    by_source = Window.partitionBy("_src")
    numbers = numbered(counts.select("_src").distinct(), ["_src"], "s")
    starts = counts.select("_range", "_src", (F.sum("c").over(by_source.orderBy("_range")) - F.col("c")).alias("before"), F.sum("c").over(by_source).alias("n")).join(numbers, "_src")
    inside = Window.partitionBy("_range", "_src").orderBy(*order, "_tie")
    own = rows.withColumn("_own", F.row_number().over(inside) - 1)
    return own.join(starts, ["_range", "_src"]).withColumn("r", F.col("before") + F.col("_own")).drop("_range", "_src", "_tie", "_own", "before")


def _height(n: Column) -> Column:
    """Levels above the leaves of a group of ``n``: 0 for one, else the digits of the last rank."""
    return F.when(n > 1, F.length(F.hex(n - 1))).otherwise(0)


def build(leaves: DataFrame, folder: str) -> Manifest:
    """Write the graph of ``leaves`` (``doc_id, source, leaf, shown``) below ``folder``."""
    spark = leaves.sparkSession
    entry = F.struct("r", "doc_id", "leaf", "shown")
    runs = ranked(leaves).groupBy("s", F.expr(f"r div {FANOUT}").alias("i")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(entry)).alias("run"))
    runs.write.parquet(f"{folder}/runs")
    runs = spark.read.parquet(f"{folder}/runs")
    top = runs.agg(F.max(_height(F.col("n")))).first()[0]
    if top is None:
        return Manifest(folder, None, 0, 0)

    def climb(tree: str, records: DataFrame, height: int) -> DataFrame:
        """Write the records of a height; returns its nodes ``s, i, n, digest``."""
        kept = f"{folder}/records/{tree}-{height}"
        records.select("s", "i", "n", joined_hash(F.col("children")).alias("digest"), "children").write.parquet(kept)
        return spark.read.parquet(kept).select("s", "i", "n", "digest")

    def parents(nodes: DataFrame) -> DataFrame:
        grouped = nodes.groupBy("s", F.expr(f"i div {FANOUT}").alias("i")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "digest"))).alias("c"))
        return grouped.select("s", "i", "n", F.col("c.digest").alias("children"))

    ends = [runs.filter("n = 1").select("s", "n", F.lit(0).alias("height"), F.get("run", F.lit(0))["leaf"].alias("subroot"))]
    nodes = runs.filter("n > 1").select("s", "i", "n", F.col("run.leaf").alias("children"))
    for height in range(1, top + 1):
        nodes = climb("leaf", nodes, height)
        done = _height(F.col("n")) == height
        ends.append(nodes.filter(done).select("s", "n", F.lit(height).alias("height"), F.col("digest").alias("subroot")))
        nodes = parents(nodes.filter(~done))
    sources = ends[0]
    for end in ends[1:]:
        sources = sources.unionByName(end)
    sources.write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")
    count = sources.count()
    source_top = len(f"{count - 1:x}") if count > 1 else 0
    nodes = sources.select(F.lit(0).cast("long").alias("s"), F.col("s").alias("i"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest"))
    for height in range(1, source_top + 1):
        nodes = climb("source", parents(nodes), height)
    return Manifest(folder, nodes.first()["digest"], top, source_top)


def _segment(children: Column, at: Column) -> Column:
    """The children that a path does not take, left and right of the one it takes."""
    left = F.concat_ws("", F.slice(children, F.lit(1), at))
    return F.struct(left.alias("before"), F.concat_ws("", F.slice(children, at + 2, F.lit(FANOUT))).alias("after"))


def _descend(nodes: DataFrame, records: DataFrame) -> DataFrame:
    """One height down: each node ``s, i, digest, path`` gives way to its children."""
    found = nodes.join(records.select("digest", "children").dropDuplicates(["digest"]), "digest")
    rows = found.select("s", "i", "path", "children", F.posexplode("children").alias("at", "digest"), *[c for c in nodes.columns if c not in ("s", "i", "digest", "path")])
    down = F.concat("path", F.array(_segment(F.col("children"), F.col("at"))))
    return rows.withColumn("path", down).withColumn("i", F.col("i") * FANOUT + F.col("at")).drop("children", "at")


def proofs(spark: SparkSession, manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``s, r, doc_id, leaf, shown, subroot, path`` of the requested leaves; ``path`` runs from leaf to root.

    ``requests`` (``s, r``: source number and rank) picks leaves; without it all leaves are
    requested. A leaf's path holds one ``before, after`` pair of joined digests per height.
    """
    if manifest.root is None:
        return spark.createDataFrame([], f"s long, r long, doc_id long, leaf string, shown string, subroot string, path array<{SEGMENT}>")

    def wanted(nodes: DataFrame, place: Column, keys: list[str]) -> DataFrame:
        return nodes if requests is None else nodes.join(requests.select("s", place.alias("i")).select(*keys).distinct(), keys, "left_semi")

    start = spark.createDataFrame([(0, 0, manifest.root)], "s long, i long, digest string")
    nodes = start.withColumn("path", F.array().cast(f"array<{SEGMENT}>"))
    for height in range(manifest.source_height, 0, -1):
        nodes = _descend(nodes, manifest.records(spark, "source", height))
    sources = manifest.read(spark, "sources")
    tops = nodes.select(F.col("i").alias("s"), "digest", "path").join(sources, "s").select("s", F.lit(0).cast("long").alias("i"), "digest", "path", "subroot", "height")
    tops = checkpointed(wanted(tops.filter("digest = subroot"), F.lit(0), ["s"]))
    nodes = None
    for height in range(manifest.height, 0, -1):
        here = tops.filter(F.col("height") == height).drop("height")
        nodes = here if nodes is None else nodes.unionByName(here)
        if height > 1:
            nodes = wanted(_descend(nodes, manifest.records(spark, "leaf", height)), F.expr(f"shiftright(r, {4 * (height - 1)})"), ["s", "i"])
    runs = manifest.read(spark, "runs").select("s", "i", "run")
    alone = tops.filter("height = 0").join(runs, ["s", "i"]).select("s", "subroot", "path", F.lit(None).cast("array<string>").alias("children"), F.posexplode("run").alias("at", "row"))
    rows = alone
    if nodes is not None:
        bottom = nodes.join(manifest.records(spark, "leaf", 1).select("digest", "children").dropDuplicates(["digest"]), "digest").join(runs, ["s", "i"])
        rows = bottom.select("s", "subroot", "path", "children", F.posexplode("run").alias("at", "row")).unionByName(alone)
    if requests is not None:
        rows = rows.join(requests.select("s", "r").distinct(), (rows["s"] == requests["s"]) & (rows["row.r"] == requests["r"]), "left_semi")
    own = F.when(F.col("children").isNotNull(), F.array(_segment(F.col("children"), F.col("at")))).otherwise(F.array().cast(f"array<{SEGMENT}>"))
    stored = F.when(F.col("children").isNotNull(), F.get("children", F.col("at"))).otherwise(F.col("subroot"))
    return rows.select("s", "row.r", "row.doc_id", stored.alias("leaf"), "row.shown", "subroot", F.reverse(F.concat("path", own)).alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"]))), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, shown`` of documents; ``shown`` is what a tampered copy would show."""
    rows = docs.select(*[F.col(name) for name, _ in FIELDS]).withColumn("leaf", leaf_digest())
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "leaf", tampered_leaf().alias("shown"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = build(document_leaves(table(spark, sf_dir, "documents")), shared_folder(spark, "merkle"))
    root = F.lit(manifest.root).cast("string")
    rows = proofs(spark, manifest).withColumn("folded_root", folded(F.col("shown"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))


def _sql(leaf_heights: int = 7, source_heights: int = 5) -> str:
    """The same in SQL, heights written out one by one, for up to 16 ** heights leaves a source."""

    def field(name: str, value: str = "") -> str:
        value = value or f"CAST({name} AS VARCHAR)"
        return f"coalesce(CAST(octet_length(encode({value})) AS VARCHAR) || ':' || {value}, '-')"

    plain = " || ".join(field(name) for name, _ in FIELDS)
    lower = " || ".join(field(name, f"translate(text, '{UPPER}', '{LOWER}')" if name == "text" else "") for name, _ in FIELDS)
    chosen = "list_contains([0, 5], CAST(right(CAST(crc AS VARCHAR), 1) AS INTEGER))"
    steps = [
        # crc32 bit by bit: SQL has no function for it.
        "bits(doc_id, k, crc, bytes) AS (SELECT doc_id, 0, 4294967295::UBIGINT, encode(CAST(doc_id AS VARCHAR)) FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) UNION ALL SELECT doc_id, k + 1, "
        "list_reduce(list_prepend(xor(crc, CAST(ascii(substr(CAST(doc_id AS VARCHAR), k + 1, 1)) AS UBIGINT)), range(8)::UBIGINT[]), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END), bytes FROM bits WHERE k < length(CAST(doc_id AS VARCHAR)))",
        "crcs AS (SELECT doc_id, xor(crc, 4294967295::UBIGINT) AS crc FROM bits WHERE k = length(CAST(doc_id AS VARCHAR)))",
        f"leaves AS (SELECT d.doc_id, source, sha256({plain.replace('doc_id', 'd.doc_id')}) AS leaf, CASE WHEN {chosen} THEN sha256({lower.replace('doc_id', 'd.doc_id')}) ELSE sha256({plain.replace('doc_id', 'd.doc_id')}) END AS shown FROM documents d LEFT JOIN crcs c ON d.doc_id = c.doc_id)",
        "l0 AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves)",
        "n0 AS (SELECT s, r AS i, leaf AS digest, count(*) OVER (PARTITION BY s) AS n FROM l0)",
    ]
    heights = [("n", leaf_heights), ("u", source_heights)]
    for name, top in heights:
        if name == "u":
            steps.append(f"u0 AS (SELECT 0 AS s, s AS i, digest, count(*) OVER () AS n FROM n{leaf_heights})")
        for h in range(1, top + 1):
            below = f"{name}{h - 1}"
            steps.append(f"{name}r{h} AS (SELECT s, i // 16 AS i, list(digest ORDER BY i) AS c, any_value(n) AS n FROM {below} GROUP BY s, i // 16)")
            steps.append(f"{name}{h} AS (SELECT s, i, CASE WHEN n > 1 THEN sha256(array_to_string(c, '')) ELSE c[1] END AS digest, count(*) OVER (PARTITION BY s) AS n FROM {name}r{h})")
    last, k = "SELECT s, r, doc_id, leaf, shown AS d, '' AS p FROM l0", 0
    for name, top in heights:
        for h in range(1, top + 1):
            group, place = ("x.s", f"(x.r // {16 ** (h - 1)})") if name == "n" else ("0", f"(x.s // {16 ** (h - 1)})")
            before, after = (f"array_to_string(t.c[{span}], '')" for span in (f":CAST({place} % 16 AS BIGINT)", f"CAST({place} % 16 AS BIGINT) + 2:"))
            before = f"CASE WHEN {place} % 16 = 0 THEN '' ELSE {before} END"
            k += 1
            steps.append(f"x{k} AS ({last})")
            last = f"SELECT x.s, x.r, doc_id, leaf, CASE WHEN t.n > 1 THEN sha256({before} || d || {after}) ELSE d END AS d, CASE WHEN t.n > 1 THEN p || {before} || {after} ELSE p END AS p FROM x{k} x JOIN {name}r{h} t ON t.s = {group} AND t.i = {place} // 16"
    steps.append(f"x AS ({last})")
    return "WITH RECURSIVE " + ",\n".join(steps) + (
        f"\nSELECT doc_id, leaf, n.digest AS subroot, u.digest AS root, sha256(p) AS proof_sha256, d AS folded_root, d = u.digest AS verified FROM x JOIN n{leaf_heights} n ON n.s = x.s, u{source_heights} u"
    )


OP13_SQL = _sql()
