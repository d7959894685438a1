"""Edits of several parallel sequences of an item, and alignment of found with expected labels.

Sequences are rows, one per slot, with a position inside the item. An *edit script* says
which slots go and which slot gets their time; applying it is one join on the position and
one scan that numbers what is left. Labels are aligned by ordinals: both sequences are
counted once, and slots with the same (number of real labels so far, number of the pause
behind it) belong together. Nothing here builds an array or compares all slots of an item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .scans import last_seen, next_seen, refine, running_sum, scan
from .sequences import beside_rests

PAUSE = "SP"


# -- failed rests: notes and phones together ------------------------------------------


def rest_edits(elements: DataFrame, phones: DataFrame, keys: Sequence[str], midi: Column, failed: Column, hot=None) -> tuple[DataFrame, DataFrame]:
    """Edit script and issues for rests that failed their evidence.

    ``elements``: keys, element, kind (note or rest), pitch, dur. ``phones``: keys,
    ph_index, phone, dur. The n-th rest of an item belongs to its n-th pause phone. A failed
    rest goes to the note beside it that is nearest in pitch, the right one on ties; its
    pause phone goes to the nearest real phone on the same side.

    Script: keys, ``list`` (note or phone), ``position`` deleted, ``recipient``, ``side``,
    ``moved``. Items without phones are edited in their notes only. An item with an issue
    (no note, no pause phone or no real phone for a failed rest) is not edited at all.
    """
    keys = list(keys)
    number = lambda side: [running_sum("rest_no", F.when(F.col("kind") == "rest", 1).otherwise(0).cast("bigint"))]
    rows = beside_rests(elements, keys, midi, failed, hot, number).where((F.col("kind") == "rest") & failed)
    target = F.when(F.col("side") == "right", F.col("r.element")).when(F.col("side") == "left", F.col("l.element"))
    rests = rows.select(*keys, "element", "rest_no", "side", target.alias("target"), F.col("dur").alias("rest_dur"))
    pause = F.upper("phone") == PAUSE
    real = F.when(~pause, F.col("ph_index"))
    marked = scan(
        phones, keys, ["ph_index"],
        [running_sum("rest_no", F.when(pause, 1).otherwise(0).cast("bigint")), last_seen("__lp", real), next_seen("__rp", real)], refine(hot, phones, keys),
    )
    pauses = marked.where(pause).select(*keys, "rest_no", "ph_index", F.col("dur").alias("ph_dur"), "__lp", "__rp")
    spoken = phones.groupBy(*keys).agg(F.lit(True).alias("spoken"))
    both = rests.join(pauses, [*keys, "rest_no"], "left").join(spoken, keys, "left")
    phone_target = F.when(F.col("side") == "right", F.col("__rp")).otherwise(F.col("__lp"))
    issue = F.when(F.col("side").isNull(), "REST_WITHOUT_NOTE").when(
        F.col("spoken"), F.when(F.col("ph_index").isNull(), "REST_WITHOUT_PAUSE").when(phone_target.isNull(), "PAUSE_WITHOUT_PHONE")
    )
    issues = both.select(*keys, "element", issue.alias("type")).where("type is not null")
    entry = lambda kind, at, to, moved: F.struct(F.lit(kind).alias("list"), at.alias("position"), to.alias("recipient"), moved.alias("moved"))
    parts = F.array_compact(F.array(
        entry("note", F.col("element"), F.col("target"), F.col("rest_dur")),
        F.when(F.col("spoken"), entry("phone", F.col("ph_index"), phone_target, F.col("ph_dur"))),
    ))
    fine = both.join(issues.select(*keys).distinct(), keys, "left_anti")
    return fine.select(*keys, "side", F.explode(parts).alias("e")).select(*keys, "e.list", "e.position", "e.recipient", "side", "e.moved"), issues


def apply_edits(rows: DataFrame, edits: DataFrame, keys: Sequence[str], position: str, unit: str | None = None, hot=None) -> DataFrame:
    """Rows left after an edit script of one list: ``position`` and ``unit`` counted anew from 1, ``dur`` with what was moved.

    A unit (a group of slots that follow each other) that loses all its slots is gone.
    """
    keys = list(keys)
    gone = edits.select(*keys, F.col("position").alias(position), F.lit(1).alias("__gone"), F.lit(0).cast("bigint").alias("__got"))
    got = edits.groupBy(*keys, F.col("recipient").alias(position)).agg(F.sum("moved").alias("__got"))
    marks = gone.unionByName(got.withColumn("__gone", F.lit(0))).groupBy(*keys, position).agg(F.max("__gone").alias("__gone"), F.sum("__got").alias("__got"))
    joined = rows.join(marks, [*keys, position], "left")
    kept = F.coalesce("__gone", F.lit(0)) == 0
    one = lambda test: F.when(test, 1).otherwise(0).cast("bigint")
    first = [running_sum("__at", one(kept))]
    second = []
    if unit:
        first.append(last_seen("__before", F.when(kept, F.col(unit)), inclusive=False))
        second = [[running_sum("__unit", one(kept & (F.col("__before").isNull() | (F.col("__before") != F.col(unit)))))]]
    left = scan(joined, keys, [position], first, refine(hot, joined, keys), *second).where(kept)
    changed = {position: F.col("__at"), "dur": F.col("dur") + F.coalesce("__got", F.lit(0))} | ({unit: F.col("__unit")} if unit else {})
    return left.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in rows.columns])


def absorb_rests(elements: DataFrame, phones: DataFrame, keys: Sequence[str], midi: Column, failed: Column, hot=None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Elements and phones after failed rests were absorbed, with the script and the issues.

    ``phones`` also have ``unit``, the lyric unit they belong to; ``unit_counts`` of the
    result are the new counts of phones per unit.
    """
    edits, issues = rest_edits(elements, phones, keys, midi, failed, hot)
    ensure_checkpoint_dir(elements.sparkSession)
    edits = edits.checkpoint()  # read for notes and phones, deleted and recipient
    notes = apply_edits(elements, edits.where("list = 'note'"), keys, "element", hot=hot)
    return notes, apply_edits(phones, edits.where("list = 'phone'"), keys, "ph_index", "unit", hot), edits, issues


def unit_counts(phones: DataFrame, keys: Sequence[str]) -> DataFrame:
    return phones.groupBy(*keys, "unit").agg(F.count(F.lit(1)).alias("ph_num"))


def rest_contract(elements: DataFrame, phones: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per item: note and phone totals, units, and as many pause phones as rests; PASS or BLOCKED."""
    keys, zero = list(keys), F.lit(0).cast("bigint")
    names = ["slots", "note_total", "rests", "phones", "ph_total", "pauses", "units"]
    a = elements.select(*keys, F.lit(1).alias("slots"), F.col("dur").alias("note_total"), F.when(F.col("kind") == "rest", 1).otherwise(0).alias("rests"))
    b = phones.select(*keys, F.lit(1).alias("phones"), F.col("dur").alias("ph_total"), F.when(F.upper("phone") == PAUSE, 1).otherwise(0).alias("pauses"), F.col("unit").alias("units"))
    rows = a.unionByName(b, allowMissingColumns=True)
    sums = rows.groupBy(*keys).agg(*[F.coalesce((F.max if n == "units" else F.sum)(n), zero).cast("bigint").alias(n) for n in names])
    same = (F.col("note_total") == F.col("ph_total")) & (F.col("rests") == F.col("pauses"))
    return sums.withColumn("status", F.when(same, "PASS").otherwise("BLOCKED"))


# -- alignment of labels ------------------------------------------------------------


def _ordinals(rows: DataFrame, keys: list[str], order: str, pause: Column, hot) -> DataFrame:
    """``__r``: real labels so far; ``__q``: number of the pause since the last real label, 0 for a real one."""
    one = lambda test: F.when(test, 1).otherwise(0).cast("bigint")
    counted = scan(rows, keys, [order], [running_sum("__r", one(~pause)), running_sum("__p", one(pause))], refine(hot, rows, keys), [last_seen("__base", F.when(~pause, F.col("__p")))])
    return counted.withColumn("__q", F.when(pause, F.col("__p") - F.coalesce("__base", F.lit(0))).otherwise(0)).drop("__p", "__base")


def align_labels(found: DataFrame, expected: DataFrame, keys: Sequence[str], silence: Sequence[str], hot=None) -> DataFrame:
    """Found intervals beside expected phones; pauses that nobody expects are skipped.

    ``found``: keys, idx, label, start, end (an empty label is the first of ``silence``).
    ``expected``: keys, pos, phone. Result: keys, pos, phone, idx, label, start, end, status:
    MATCH, LABEL_MISMATCH, MISSING (expected only), UNEXPECTED (found only) or SKIPPED_PAUSE.
    Of a run of pauses as many are taken as are expected between the same two real labels.
    """
    keys, is_pause = list(keys), lambda c: F.col(c).isin(*silence)
    named = found.withColumn("label", F.when(F.coalesce("label", F.lit("")) == "", F.lit(silence[0])).otherwise(F.col("label")))
    left = _ordinals(expected, keys, "pos", is_pause("phone"), hot)
    right = _ordinals(named, keys, "idx", is_pause("label"), hot)
    both = left.join(right, [*keys, "__r", "__q"], "full_outer")
    status = F.when(F.col("pos").isNull(), F.when(is_pause("label"), "SKIPPED_PAUSE").otherwise("UNEXPECTED")).when(F.col("idx").isNull(), "MISSING")
    status = status.when(is_pause("label") | (F.col("label") == F.col("phone")), "MATCH").otherwise("LABEL_MISMATCH")
    return both.select(*keys, "pos", "phone", "idx", "label", "start", "end", status.alias("status"))


def alignment_issues(pairs: DataFrame, keys: Sequence[str], forbidden: str = "spn") -> DataFrame:
    """Contract of an alignment, one row ``keys, type`` per broken rule of an item."""
    kept = F.col("idx").isNotNull() & (F.col("status") != "SKIPPED_PAUSE")
    tests = {
        "MFA_FORBIDDEN_PHONE": kept & (F.col("label") == forbidden),
        "MFA_PHONE_SEQUENCE_MISMATCH": F.col("status").isin("LABEL_MISMATCH", "MISSING", "UNEXPECTED"),
        "MFA_NON_POSITIVE_PHONE_DURATION": kept & (F.col("end") <= F.col("start")),
    }
    found = pairs.groupBy(*keys).agg(*[F.max(test).alias(name) for name, test in tests.items()])
    types = F.array_compact(F.array(*[F.when(F.col(name), F.lit(name)) for name in tests]))
    return found.select(*keys, F.explode(types).alias("type"))


def boundary_edits(pairs: DataFrame, items: DataFrame, keys: Sequence[str], silence: Sequence[str], eps: int = 1) -> DataFrame:
    """What happens to time before the first and behind the last kept interval of an item.

    ``items``: keys, item_end, lead_rest, trail_rest (whether its notes begin or end with a
    rest). Result: keys, side, gap, resolution: PAUSE_INSERTED where the notes have a rest
    there, else PHONE_EXTENDED; BOUNDARY_UNEXPLAINED where the time is not covered by
    silence alone.
    """
    keys = list(keys)
    kept = F.col("idx").isNotNull() & (F.col("status") != "SKIPPED_PAUSE")
    ends = pairs.groupBy(*keys).agg(F.min_by("start", F.when(kept, F.col("idx"))).alias("first_start"), F.max_by("end", F.when(kept, F.col("idx"))).alias("last_end"))
    items = items.join(ends, keys, "left").withColumns({"first_start": F.coalesce("first_start", "item_end"), "last_end": F.coalesce("last_end", F.lit(0))})
    rows = pairs.where("idx is not null").select(*keys, "label", "start", "end").join(items, keys)
    early = (F.col("start") < F.col("first_start") - eps) & (F.col("end") > F.col("start"))
    late = (F.col("end") > F.col("last_end") + eps) & (F.col("start") >= F.col("last_end") - 2 * eps)
    other = ~F.col("label").isin(*silence)
    seen = rows.groupBy(*keys).agg(F.count_if(early).alias("early"), F.count_if(early & other).alias("early_bad"), F.count_if(late).alias("late"), F.count_if(late & other).alias("late_bad"))
    wide = items.join(seen, keys, "left").na.fill(0, ["early", "early_bad", "late", "late_bad"])

    def edge(side: str, gap: Column, n: str, bad: str, rest: str) -> Column:
        how = F.when((F.col(n) == 0) | (F.col(bad) > 0), "BOUNDARY_UNEXPLAINED").when(F.col(rest), "PAUSE_INSERTED").otherwise("PHONE_EXTENDED")
        return F.when(gap > eps, F.struct(F.lit(side).alias("side"), gap.alias("gap"), how.alias("resolution")))

    sides = F.array_compact(F.array(
        edge("leading", F.col("first_start"), "early", "early_bad", "lead_rest"),
        edge("trailing", F.col("item_end") - F.col("last_end"), "late", "late_bad", "trail_rest"),
    ))
    return wide.select(*keys, F.explode(sides).alias("e")).select(*keys, "e.*")


def aligned_phones(pairs: DataFrame, edits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Phones of items without an issue: keys, pos (from 0), phone, dur, inserted.

    Boundary time goes to the first or last phone or becomes a pause phone of its own.
    """
    keys = list(keys)
    broken = alignment_issues(pairs, keys).select(*keys).unionByName(edits.where("resolution = 'BOUNDARY_UNEXPLAINED'").select(*keys)).distinct()
    part = lambda side, how: F.sum(F.when((F.col("side") == side) & (F.col("resolution") == how), F.col("gap")))
    wide = edits.groupBy(*keys).agg(
        part("leading", "PAUSE_INSERTED").alias("lead_pause"), part("leading", "PHONE_EXTENDED").alias("lead_more"),
        part("trailing", "PAUSE_INSERTED").alias("trail_pause"), part("trailing", "PHONE_EXTENDED").alias("trail_more"),
    )
    good = pairs.where("status = 'MATCH'").join(broken, keys, "left_anti")
    span = good.groupBy(*keys).agg(F.min("pos").alias("__first"), F.max("pos").alias("__last")).join(wide, keys, "left")
    shift = F.when(F.col("lead_pause").isNotNull(), 1).otherwise(0)
    more = F.when(F.col("pos") == F.col("__first"), F.coalesce("lead_more", F.lit(0))).otherwise(0) + F.when(F.col("pos") == F.col("__last"), F.coalesce("trail_more", F.lit(0))).otherwise(0)
    phones = good.join(span, keys).select(*keys, (F.col("pos") + shift).alias("pos"), "phone", (F.col("end") - F.col("start") + more).alias("dur"), F.lit(False).alias("inserted"))
    pause = lambda pos, dur: F.when(dur.isNotNull(), F.struct(pos.cast("bigint").alias("pos"), F.lit(PAUSE).alias("phone"), dur.alias("dur"), F.lit(True).alias("inserted")))
    added = F.array_compact(F.array(pause(F.lit(0), F.col("lead_pause")), pause(F.col("__last") + 1 + shift, F.col("trail_pause"))))
    return phones.unionByName(span.select(*keys, F.explode(added).alias("p")).select(*keys, "p.*"))


# -- counts in ranges ---------------------------------------------------------------


def range_counts(ranges: DataFrame, points: DataFrame, keys: Sequence[str], range_id: Sequence[str], hot=None) -> DataFrame:
    """How many weights of ``points`` (keys, at, weight) lie in each range [start, end): keys, range_id, total.

    Both borders read one running sum over the points; the difference is the count, so no
    range meets its points.
    """
    keys, ids = list(keys), list(range_id)
    border = lambda at, sign: F.struct(F.col(at).alias("at"), F.lit(sign).alias("sign"))
    borders = ranges.select(*keys, *ids, F.explode(F.array(border("start", -1), border("end", 1))).alias("b")).select(*keys, *ids, "b.at", "b.sign")
    marks = points.select(*keys, "at", "weight", F.lit(0).alias("sign"))
    # A border comes before a point at the same place: it counts what lies before it.
    rows = borders.withColumn("weight", F.lit(0).cast("bigint")).unionByName(marks, allowMissingColumns=True).withColumn("__late", F.col("sign") == 0)
    summed = scan(rows, keys, ["at", "__late", "sign", *ids, "weight"], [running_sum("__sum", F.col("weight").cast("bigint"))], refine(hot, rows, keys))
    return summed.where("sign <> 0").groupBy(*keys, *ids).agg(F.sum(F.col("sign") * F.col("__sum")).alias("total"))


def voiced_pauses(phones: DataFrame, frames: DataFrame, keys: Sequence[str], pauses: Sequence[str] = ("SP", "AP"), hot=None) -> DataFrame:
    """Pause phones over voiced frames: keys, ph_index, phone, voiced (the number of frames).

    ``phones``: keys, ph_index, phone, dur, in time units from 0. ``frames``: keys, at (a
    frame's middle), f0.
    """
    keys = list(keys)
    placed = scan(phones, keys, ["ph_index"], [running_sum("end", F.col("dur"))], refine(hot, phones, keys))
    spans = placed.where(F.col("phone").isin(*pauses)).select(*keys, "ph_index", "phone", (F.col("end") - F.col("dur")).alias("start"), "end")
    voiced = frames.where("f0 > 0").select(*keys, "at", F.lit(1).alias("weight"))
    found = range_counts(spans, voiced, keys, ["ph_index", "phone"], hot)
    return found.where("total > 0").withColumnRenamed("total", "voiced")
