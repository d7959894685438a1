"""Shards by balanced label propagation, in DataFrame operations only.

Documents that share a link group (here: equal texts) should share a shard. Groups of over
an eighth of a shard, at most 8 a shard, are placed first, the largest first: whole where
one fits, else in the emptiest shards until their size is covered. Rounds of joins move the
other linked documents towards the shard with room where most of their group sits, limited
by the room; the last round moves the rest of each group, too. Documents without links have
no wish and fill the gaps. No pairs are made: a group is represented by its counts per
shard, aggregated before the shuffle.

The last step is exact: with N documents and S shards every shard gets N // S or one more
(law ``rows``). Linked documents stay where they are up to their shard's quota; those beyond
it and all unlinked ones are numbered in group order and dealt to the gaps in one run, so
groups beyond a quota stay together but at the borders of gaps. The numberings are range
partitionings; only S + 1 counts and the sizes of the large groups reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, numbered, table

SHARDS = 16
ROUNDS = 3


def _chance(*columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) / float(1 << 20)


def placed(sizes: list[int], quotas: list[int]) -> tuple[list[list[tuple[int, int]]], list[int]]:
    """Runs ``(shard, rows)`` of each group, and the room that all of them leave in each shard."""
    room, runs = list(quotas), [[] for _ in sizes]
    for g in sorted(range(len(sizes)), key=lambda g: -sizes[g]):
        left = sizes[g]
        while left:
            fits = [s for s in range(len(room)) if room[s] >= left]
            s = min(fits, key=lambda s: room[s]) if fits else max(range(len(room)), key=lambda s: room[s])
            n = min(left, room[s])
            runs[g].append((s, n))
            room[s] -= n
            left -= n
    return runs, room


def place_large(rows: DataFrame, quotas: list[int]) -> tuple[DataFrame, list[int]]:
    """Adds ``shard`` to the rows of large groups; also returns the room left in each shard."""
    found = checkpointed(numbered(rows, ["grp", "key"]))
    groups = found.groupBy("grp").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("first").collect()
    runs, room = placed([g["n"] for g in groups], quotas)
    plan = []
    for g, parts in zip(groups, runs):
        at = g["first"]
        for s, n in parts:
            plan.append((g["grp"], at, at + n, s))
            at += n
    plan = rows.sparkSession.createDataFrame(plan, "grp binary, low long, high long, shard int")
    made = found.join(F.broadcast(plan), "grp").filter("number >= low and number < high")
    return made.select("doc_id", "size_bytes", "crc", "grp", "key", "shard"), room


def propagate(rows: DataFrame, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Adds ``shard`` to linked ``rows`` (``grp``, ``key``) after ``rounds`` of moves; ``room`` is what each shard can take."""
    state = checkpointed(rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(len(room))).cast("int")))
    rooms = F.broadcast(rows.sparkSession.createDataFrame(list(enumerate(room)), "shard int, room long"))
    for k in range(rounds):
        cells = state.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
        full = cells.groupBy("shard").agg(F.sum("n").alias("have")).join(rooms, "shard").select("shard", (F.col("have") < F.col("room")).alias("open"))
        cells = cells.join(F.broadcast(full), "shard")
        # The fullest shard of a group, of those with room if there are any; ties are broken differently for every group.
        wish = cells.groupBy("grp").agg(F.max_by("shard", F.struct("open", "n", F.xxhash64("grp", "shard"))).alias("wish"))
        cells = checkpointed(cells.join(wish, "grp"))
        # A shard has room for its quota less those who wish to stay.
        staying = cells.filter("shard = wish").groupBy("shard").agg(F.sum("n").alias("stays"))
        coming = cells.filter("shard <> wish").groupBy(F.col("wish").alias("shard")).agg(F.sum("n").alias("comes"))
        share = coming.join(rooms, "shard").join(staying, "shard", "left").select(F.col("shard").alias("wish"), (F.greatest(F.lit(0), F.col("room") - F.coalesce("stays", F.lit(0))) / F.col("comes")).alias("share"))
        wish = cells.groupBy("grp").agg(F.first("wish").alias("wish")).join(F.broadcast(share), "wish", "left").fillna(0.0, ["share"])
        # Groups move whole, in the last round beyond the room as well: what is over the quota is dealt on in group order.
        moves = F.lit(True) if k + 1 == rounds else _chance("grp", F.lit(k)) < F.col("share")
        moved = state.join(wish, "grp").select("doc_id", "size_bytes", "crc", "grp", "key", F.when(moves, F.col("wish")).otherwise(F.col("shard")).alias("shard"))
        state = checkpointed(moved)
    return state


def shard_rows(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    Size is the text's UTF-8 bytes plus 1; null and empty texts have size 1 and are equal
    texts. Null and repeated doc_ids are rows like any other. Slots are gapless from 0 in
    every shard; counts differ by at most one. Empty tables give no rows; other columns
    are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", (F.octet_length("text") + F.lit(1)).cast("long").alias("size_bytes"), F.crc32("text").alias("crc"), F.unhex(F.sha2("text", 256)).alias("grp"))
    rows = checkpointed(rows.withColumn("key", F.monotonically_increasing_id()))
    n = rows.count()
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    sizes = checkpointed(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"))
    is_large = F.col("members") * 8 > max(quotas)
    large, room = place_large(rows.join(F.broadcast(sizes.filter(is_large).select("grp")), "grp"), quotas)
    linked = propagate(rows.join(sizes.filter(~is_large).select("grp"), "grp"), room, rounds)
    free = rows.join(sizes, "grp", "left_anti").select("doc_id", "size_bytes", "crc", "grp", "key", F.lit(shards).alias("shard"))
    # Large groups have their exact room, so they come first in their shards.
    every = large.withColumn("later", F.lit(0)).unionByName(linked.unionByName(free).withColumn("later", F.lit(1)))
    found = numbered(every, ["shard", "later", "grp", "doc_id"])
    found = checkpointed(found)

    counts = {r["shard"]: r["n"] for r in found.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, gaps, first, spill, gap = [], [], 0, 0, 0
    for s in range(shards):
        quota, have = quotas[s], counts.get(s, 0)
        kept = min(quota, have)
        plan.append((s, first, kept, spill))
        if quota > kept:
            gaps.append(F.struct(F.lit(gap).cast("long").alias("gap"), F.lit(s).alias("shard"), F.lit(kept).cast("long").alias("kept")))
        first, spill, gap = first + have, spill + have - kept, gap + quota - kept
    plan.append((shards, first, 0, spill))
    plan = docs.sparkSession.createDataFrame(plan, "shard int, first long, kept long, spill long")
    ranked = found.join(F.broadcast(plan), "shard").withColumn("rank", F.col("number") - F.col("first"))
    dealt = ranked.filter("rank < kept").withColumn("slot", F.col("rank"))
    if gaps:
        # Everyone else has one place in a common queue; each gap takes a run of the queue.
        queue = ranked.filter("rank >= kept").withColumn("place", F.col("spill") + F.col("rank") - F.col("kept"))
        queue = queue.withColumn("to", F.element_at(F.filter(F.array(*gaps), lambda g: g["gap"] <= F.col("place")), -1))
        late = queue.withColumn("shard", F.col("to.shard")).withColumn("slot", F.col("to.kept") + F.col("place") - F.col("to.gap"))
        dealt = dealt.unionByName(late.select(dealt.columns))
    return dealt.select("doc_id", F.col("size_bytes").alias("size"), F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))
