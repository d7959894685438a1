"""Ordered scans (running sum, running max, lag, lead, forward fill, row number) per key.

A plain window puts all rows of one key into one task. That is the best plan while
every key fits a task, and a dead end when one song holds a third of the corpus.
``scan`` therefore counts rows per key first (partial aggregation, one column) and then

* with no hot key: one shuffle on the key and a window, nothing else;
* with hot keys (more than ``max_rows_per_task`` rows): the order of each hot key is cut
  into chunks at sampled positions, the rows are checkpointed with their chunk number,
  windows run inside ``(key, chunk)``, one pre-aggregated row per chunk is scanned
  again, and its carry is added back through a join on ``(key, chunk)``.

The checkpoint keeps plans linear when scans follow one another, and both branches
read the same rows, so a lost executor cannot change the chunking. Results do not
depend on where the cuts are or on which keys count as hot; only task sizes do.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

MAX_ROWS_CONF = "spark.tessitura.maxRowsPerTask"
DEFAULT_MAX_ROWS = 4_000_000
SAMPLES_PER_CHUNK = 32
CHUNK = "__chunk"


def max_rows_per_task(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS)))


@dataclasses.dataclass(frozen=True)
class HotKeys:
    """Keys with more rows than a task should hold, at most total_rows / limit of them."""

    keys: tuple[str, ...]
    counts: tuple[tuple, ...]
    schema: T.StructType

    def __bool__(self) -> bool:
        return bool(self.counts)

def find_hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> HotKeys:
    """Count rows per key with partial aggregation and keep the keys over the limit."""
    limit = limit or max_rows_per_task(df)
    schema = T.StructType([df.schema[k] for k in keys])
    if keys:
        rows = df.groupBy(*keys).count().where(F.col("count") > limit).collect()
    else:
        rows = df.agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > limit).collect()
    return HotKeys(tuple(keys), tuple(tuple(r) for r in rows), schema)


def refine(hot: HotKeys | None, df: DataFrame, keys: Sequence[str]) -> HotKeys | None:
    """Hot keys of a finer grouping: none when no coarser key is hot, else counted again."""
    if hot is not None and not hot:
        return HotKeys(tuple(keys), (), T.StructType([df.schema[k] for k in keys]))
    return find_hot_keys(df, keys)


@dataclasses.dataclass(frozen=True)
class Scan:
    """One ordered computation. ``op`` is sum, max, min, last, lag or row_number.

    ``inclusive`` says whether the current row counts; ``reverse`` scans from the far
    end (``last`` then means the next non-null value, ``lag`` the following row).
    """

    name: str
    op: str
    value: Column | None = None
    inclusive: bool = False
    reverse: bool = False


def running_sum(name, value, inclusive=True):
    return Scan(name, "sum", value, inclusive)


def running_max(name, value, inclusive=False):
    return Scan(name, "max", value, inclusive)


def previous(name, value):
    return Scan(name, "lag", value)


def following(name, value):
    return Scan(name, "lag", value, reverse=True)


def last_seen(name, value, inclusive=True):
    return Scan(name, "last", value, inclusive)


def next_seen(name, value, inclusive=True):
    return Scan(name, "last", value, inclusive, reverse=True)


def row_number(name):
    return Scan(name, "row_number", F.lit(1).cast("bigint"), inclusive=True)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scans: Sequence[Scan],
    hot: HotKeys | None = None,
    *stages: Sequence[Scan],
) -> DataFrame:
    """Add one column per scan. ``order`` must be a total order inside each key.

    ``stages`` are further lists of scans over the same keys and order that may use the
    columns of earlier ones; they cost no further shuffle.
    """
    keys, order = list(keys), list(order)
    if hot is None:
        hot = find_hot_keys(df, keys)
    if not hot:
        for step in (scans, *stages):
            df = _windowed(df, keys, order, step)
        return df
    rows = assign_chunks(df, keys, order, hot)
    for step in (scans, *stages):
        rows = _chunked(rows, keys, order, step)
    return rows.drop(CHUNK)


def _over(s: Scan, partition: Sequence[Column | str], order: Sequence[str]) -> Column:
    window = Window.partitionBy(*partition)
    if s.op == "lag":
        return (F.lead if s.reverse else F.lag)(s.value).over(window.orderBy(*order))
    # A frame that grows backwards would be re-read for every row, so a reverse scan
    # sorts the other way and still grows forwards.
    window = window.orderBy(*[F.col(o).desc() if s.reverse else F.col(o).asc() for o in order])
    frame = window.rowsBetween(Window.unboundedPreceding, 0 if s.inclusive else -1)
    fold = {"sum": F.sum, "row_number": F.sum, "max": F.max, "min": F.min}
    if s.op == "last":
        return F.last(s.value, ignorenulls=True).over(frame)
    return fold[s.op](s.value).over(frame)


def _windowed(df, keys, order, scans):
    part = keys or [F.lit(0)]
    return df.select("*", *[_over(s, part, order).alias(s.name) for s in scans])


def _cut_points(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys) -> dict[tuple, list[tuple]]:
    """Sampled cut positions per hot key: about rows / limit of them, sorted."""
    limit = max_rows_per_task(df)
    total = sum(row[-1] for row in hot.counts)
    chunks = {row[:-1]: max(2, -(-row[-1] // limit)) for row in hot.counts}
    wanted = SAMPLES_PER_CHUNK * sum(chunks.values())
    sample = df.select(*keys, F.struct(*order).alias("__at"))
    if wanted < total:
        sample = sample.sample(fraction=min(1.0, wanted / total), seed=7)
    found: dict[tuple, list] = {}
    for row in sample.collect():
        found.setdefault(tuple(row[: len(keys)]), []).append(row["__at"])
    null_first = lambda at: tuple((v is not None, v) for v in at)
    cuts = {}
    for key, points in found.items():
        points.sort(key=null_first)
        parts = chunks.get(key, 1)
        cuts[key] = [points[len(points) * i // parts] for i in range(1, parts)]
    return cuts


def assign_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotKeys) -> DataFrame:
    """Number the chunks of each hot key in order; rows of other keys get chunk 0."""
    keys, order = list(keys), list(order)
    cuts = _cut_points(df, keys, order, hot)
    at = F.struct(*order)
    at_type = df.select(at.alias("at")).schema["at"].dataType
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("__cuts", T.ArrayType(at_type))])
    table = df.sparkSession.createDataFrame([(*k, v) for k, v in cuts.items()], schema)
    steps = 1
    while steps <= max((len(v) for v in cuts.values()), default=1):
        steps *= 2
    halves = F.array(*[F.lit(steps >> i) for i in range(1, steps.bit_length())])
    # Binary search: how many cut positions are at or before this row.
    place = F.aggregate(
        halves,
        F.lit(0),
        lambda low, half: F.when(
            (low + half <= F.size("__cuts")) & (F.try_element_at(F.col("__cuts"), low + half) <= at), low + half
        ).otherwise(low),
    )
    if keys:
        table = F.broadcast(table.withColumnsRenamed({k: f"__k_{k}" for k in keys}))
        joined = df.join(table, [df[k].eqNullSafe(F.col(f"__k_{k}")) for k in keys], "left")
    else:
        joined = df.withColumn("__cuts", table.scalar())
    numbered = joined.withColumn(CHUNK, F.coalesce(place, F.lit(0))).select(*df.columns, CHUNK)
    ensure_checkpoint_dir(df.sparkSession)
    return numbered.checkpoint()


def _chunked(rows: DataFrame, keys, order, scans) -> DataFrame:
    at = F.struct(*order)
    local = rows.select(
        "*",
        *[_over(s, [*keys, CHUNK], order).alias(s.name) for s in scans],
        *[
            _over(Scan("", "lag", F.lit(True), reverse=r), [*keys, CHUNK], order).isNull().alias(f"__edge_{int(r)}")
            for r in {s.reverse for s in scans if s.op == "lag"}
        ],
    )
    totals = rows.groupBy(*keys, CHUNK).agg(*[_chunk_total(s, at).alias(f"__c_{s.name}") for s in scans])
    carried = totals.select(
        *[F.col(k).alias(f"__k_{k}") for k in [*keys, CHUNK]],
        *[_carry(s, keys).alias(f"__c_{s.name}") for s in scans],
    )
    joined = local.join(carried, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in [*keys, CHUNK]], "left")
    return joined.select(*rows.columns, *[_combine(s).alias(s.name) for s in scans])


def _chunk_total(s: Scan, at: Column) -> Column:
    pick = F.min_by if s.reverse else F.max_by
    if s.op == "lag":
        return pick(F.struct(s.value.alias("v")), at)
    if s.op == "last":
        return pick(s.value, F.when(s.value.isNotNull(), at))
    return {"sum": F.sum, "row_number": F.sum, "max": F.max, "min": F.min}[s.op](s.value)


def _carry(s: Scan, keys) -> Column:
    part = keys or [F.lit(0)]
    over = Scan("", s.op, F.col(f"__c_{s.name}"), inclusive=False, reverse=s.reverse)
    return _over(over, part, [CHUNK])


def _combine(s: Scan) -> Column:
    here, carry = F.col(s.name), F.col(f"__c_{s.name}")
    if s.op == "lag":
        return F.when(F.col(f"__edge_{int(s.reverse)}"), carry["v"]).otherwise(here)
    if s.op == "last":
        return F.coalesce(here, carry)
    if s.op in ("sum", "row_number"):
        return F.coalesce(here + carry, here, carry)
    return (F.greatest if s.op == "max" else F.least)(here, carry)
