"""Clip and song manifests: review rules, shares, leakage, integrity, splits, packages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scans import row_number, running_sum, scan

SPLITS = ("train", "validation", "benchmark")


# -- row rules --------------------------------------------------------------------


def all_reasons(rules: dict[str, Column]) -> Column:
    """Names of all rules that hold, joined by commas, in rule order; null when none."""
    hits = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return F.nullif(F.array_join(hits, ","), F.lit(""))


def first_reason(rules: dict[str, Column]) -> Column:
    """Name of the first rule that holds."""
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in rules.items()])


def review_reasons(clips: DataFrame, confirmed: str = "confirmed") -> DataFrame:
    rules = {
        "status_not_accepted": ~F.col("status").eqNullSafe("accepted"),
        "singer_not_confirmed": ~F.col("singer_status").eqNullSafe(confirmed),
        "quality_not_clean": ~F.col("quality").eqNullSafe("clean"),
    }
    return clips.withColumn("reject_reason", all_reasons(rules))


def build_reasons(clips: DataFrame, songs: DataFrame, low: int = 3_000, high: int = 12_000) -> DataFrame:
    """First failing build rule per clip. ``songs`` has ``song_id, song_split, source_path``."""
    found = clips.join(songs.withColumn("__song", F.lit(True)), "song_id", "left")
    rules = {
        "song_missing": F.col("__song").isNull(),
        "split_unassigned": ~F.col("song_split").isin(*SPLITS) | F.col("song_split").isNull(),
        "duration_out_of_range": ~F.col("duration_ms").between(low, high),
        "source_missing": F.coalesce(F.col("source_path"), F.lit("")) == "",
    }
    return found.withColumn("reject_reason", first_reason(rules)).drop("__song")


def field_issues(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row ``(code, key)`` per failed rule and row."""
    codes = F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in rules.items()]))
    return rows.select(F.explode(codes).alias("code"), F.col(key))


# -- groups -----------------------------------------------------------------------


def duplicates(rows: DataFrame, column: Column, name: str) -> DataFrame:
    """Values that occur more than once."""
    counted = rows.select(column.alias("value")).where("value is not null").groupBy("value").count()
    return counted.where("count > 1").select(F.lit(name).alias("field"), "value", F.col("count").alias("copies"))


def split_leakage(rows: DataFrame, group: str, split: str = "split", checked: Sequence[str] = SPLITS) -> DataFrame:
    """Groups present in more than one of the checked splits."""
    flags = [F.max(F.when(F.col(split) == s, 1).otherwise(0)).alias(s) for s in checked]
    found = rows.where(F.col(group).isNotNull()).groupBy(group).agg(*flags)
    n = sum((F.col(s) for s in checked), F.lit(0)).cast("bigint")
    names = F.array_join(F.array_compact(F.array(*[F.when(F.col(s) == 1, F.lit(s)) for s in checked])), ",")
    return found.select(group, n.alias("split_count"), names.alias("splits")).where("split_count > 1")


def song_share(clips: DataFrame, max_share=(1, 3)) -> DataFrame:
    """Duration per song, its share of the total, and whether it exceeds the maximum."""
    per_song = clips.groupBy("song_id").agg(F.sum("duration_ms").alias("duration_ms"))
    total = per_song.agg(F.sum("duration_ms")).scalar()
    num, den = max_share
    return per_song.withColumn("total_ms", total).select(
        "song_id", "duration_ms", "total_ms",
        F.round(F.col("duration_ms") / F.nullif("total_ms", F.lit(0)), 6).alias("share"),
        (F.col("duration_ms") * den > F.col("total_ms") * num).alias("over"),
    )


def coverage(rows: DataFrame, categories: dict[str, Column], group: str, min_rows=3, min_groups=2) -> DataFrame:
    """Rows and distinct groups per category; a category without rows appears with zeros."""
    long = rows.select(group, F.explode(F.array(*[
        F.struct(F.lit(n).alias("category"), F.coalesce(test, F.lit(False)).alias("hit")) for n, test in categories.items()
    ])).alias("c")).select(group, "c.*")
    # Groups first, so that a category held by one giant song is pre-aggregated.
    per_group = long.groupBy("category", group).agg(F.count_if("hit").alias("n"))
    out = per_group.groupBy("category").agg(
        F.sum("n").alias("clips"), F.count_if((F.col("n") > 0) & F.col(group).isNotNull()).alias("songs")
    )
    return out.withColumn("insufficient", (F.col("clips") < min_rows) | (F.col("songs") < min_groups))


def error_report(issues: DataFrame) -> DataFrame:
    """Rows, first and last line per error code; the lines themselves stay rows."""
    return issues.groupBy("code").agg(
        F.count(F.lit(1)).alias("rows"), F.min("line").alias("first_line"), F.max("line").alias("last_line")
    )


# -- integrity --------------------------------------------------------------------


def integrity(current: DataFrame, register: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per difference between the current files and the register.

    Kinds: ``MISSING`` (registered, not there), ``UNREGISTERED``, and ``<column>_mismatch``.
    """
    a = current.select(key, *[F.col(c).alias(f"now_{c}") for c in columns], F.lit(True).alias("here"))
    b = register.select(key, *[F.col(c).alias(f"was_{c}") for c in columns], F.lit(True).alias("known"))
    both = a.join(b, key, "full_outer")
    rules = [F.when(F.col("here").isNull(), F.lit("MISSING")), F.when(F.col("known").isNull(), F.lit("UNREGISTERED"))]
    there = F.col("here") & F.col("known")
    rules += [F.when(there & ~F.col(f"now_{c}").eqNullSafe(F.col(f"was_{c}")), F.lit(f"{c}_mismatch")) for c in columns]
    return both.select(key, F.explode(F.array_compact(F.array(*rules))).alias("kind"))


def reconcile(current: DataFrame, register: DataFrame, key: str, value: str) -> DataFrame:
    """Counts of equal, different, unreferenced and missing members with a pass flag."""
    both = current.select(key, F.col(value).alias("a")).join(register.select(key, F.col(value).alias("b")), key, "full_outer")
    out = both.agg(
        F.count_if(F.col("a") == F.col("b")).alias("equal"),
        F.count_if(F.col("a") != F.col("b")).alias("different"),
        F.count_if(F.col("b").isNull()).alias("unreferenced"),
        F.count_if(F.col("a").isNull()).alias("missing"),
    )
    return out.withColumn("passed", F.col("different") + F.col("unreferenced") + F.col("missing") == 0)


def copy_plan(source: DataFrame, target: DataFrame, key: str, value: str) -> DataFrame:
    """COPY, SKIP (same content) or CONFLICT (other content) per source file."""
    have = target.select(key, F.col(value).alias("__there"))
    act = F.when(F.col("__there").isNull(), "COPY").when(F.col("__there") == F.col(value), "SKIP").otherwise("CONFLICT")
    return source.select(key, value).join(have, key, "left").select(key, value, act.alias("action"))


def id_sets(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """Ids that are not present exactly once on every side, with the count per side."""
    long = None
    for name, rows in sides.items():
        part = rows.select(F.col(key), *[F.lit(int(n == name)).cast("bigint").alias(n) for n in sides])
        long = part if long is None else long.unionByName(part)
    counts = long.groupBy(key).agg(*[F.sum(n).alias(n) for n in sides])
    odd = None
    for n in sides:
        odd = (F.col(n) != 1) if odd is None else odd | (F.col(n) != 1)
    return counts.where(odd)


# -- splits and numbering ---------------------------------------------------------


def split_by_prefix(rows: DataFrame, name: str, policy: Sequence[tuple[str, str]]) -> DataFrame:
    """First matching prefix decides the split. ``policy`` lists (prefix, split) in priority order."""
    picks = [F.when(F.col(name).startswith(p), F.lit(s)) for p, s in policy]
    return rows.withColumn("assigned", F.coalesce(*picks))


def rank_limited_split(rows: DataFrame, order: str, duration: str, train: int, bench: int, low: int, high: int) -> DataFrame:
    """First ``train`` rows, then the next ``bench`` rows of fitting length, then the rest.

    Both borders are distributed top-n reads; the row order is never built as a whole.
    ``order`` must be unique.
    """
    last = rows.select(order).orderBy(order).limit(train).agg(F.max(order)).scalar()
    rest = rows.withColumn("__last", last)
    fits = (F.col(order) > F.col("__last")) & F.col(duration).between(low, high)
    second = rest.where(fits).select(order).orderBy(order).limit(bench)
    tagged = rest.withColumns({"__bench": second.agg(F.max(order)).scalar(), "__got": second.agg(F.count(F.lit(1))).scalar()})
    split = F.when(F.col(order) <= F.col("__last"), "smoke_train").when(fits & (F.col(order) <= F.col("__bench")), "smoke_benchmark")
    return tagged.select(*rows.columns, split.otherwise("train").alias("assigned"), (F.col("__got") >= bench).alias("enough"))


def sequential_ids(rows: DataFrame, order: Sequence[str], prefix: str, start: int = 0, width: int = 6, hot=None) -> DataFrame:
    numbered = scan(rows, [], order, [row_number("__n")], hot)
    return numbered.withColumn("seq_id", F.format_string(f"{prefix}%0{width}d", F.col("__n") + start)).drop("__n")


def allocate(rows: DataFrame, totals: DataFrame, keys: Sequence[str], index: str, weight: str, hot=None) -> DataFrame:
    """Largest-remainder shares of ``total`` per key, at least one each, ties to the earlier row.

    ``totals`` has the keys and ``total``. All arithmetic is on integers, so the parts
    add up exactly. A key whose total is absent or below its row count gives null counts.
    """
    keys = list(keys)
    w = F.greatest(F.col(weight), F.lit(0)).cast("bigint")
    sums = rows.groupBy(*keys).agg(F.sum(w).alias("__w"), F.count(F.lit(1)).alias("__n"))
    facts = sums.join(totals, keys, "left").fillna(0, ["total"])
    joined = rows.join(facts, keys)
    even = F.col("__w") == 0
    share = F.when(even, F.lit(1)).otherwise(w)
    base = F.when(even, F.col("__n")).otherwise(F.col("__w"))
    pool = (F.col("total") - F.col("__n")) * share
    parts = joined.withColumn("__pool", pool).withColumn("__base", base)
    parts = parts.withColumn("__floor", F.expr("__pool div __base")).withColumn("__neg", F.expr("-(__pool % __base)"))
    given = parts.groupBy(*keys).agg(F.sum("__floor").alias("__given"))
    ranked = scan(parts, keys, ["__neg", index], [row_number("__rank")], hot).join(given, keys)
    left = F.col("total") - F.col("__n") - F.col("__given")
    count = 1 + F.col("__floor") + F.when(F.col("__rank") <= left, 1).otherwise(0)
    fits = F.col("total") >= F.col("__n")
    return ranked.select(*rows.columns, "total", F.when(fits, count).cast("bigint").alias("allocated"))


def slices(rows: DataFrame, keys: Sequence[str], order: Sequence[str], count: str, hot=None) -> DataFrame:
    """Half-open ranges [from, to) that consecutive rows take from a shared sequence."""
    taken = scan(rows, keys, order, [running_sum("slice_to", F.col(count))], hot)
    return taken.withColumn("slice_from", F.col("slice_to") - F.col(count))


def ordered_union(parts: Sequence[DataFrame], value: str, position: str) -> DataFrame:
    """Distinct values of several lists in the order of their first appearance."""
    both = None
    for i, rows in enumerate(parts):
        one = rows.select(F.col(value), F.struct(F.lit(i).alias("list"), F.col(position).alias("at")).alias("first"))
        both = one if both is None else both.unionByName(one)
    return both.groupBy(value).agg(F.min("first").alias("first"))
