"""Score items and phrase timing: contracts, offsets, slurs, rescaling, span filling, rests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from .manifest import all_reasons
from .scans import following, last_seen, next_seen, previous, refine, running_max, running_sum, scan

REQUIRED = ("offset", "text", "lang", "ph_seq", "ph_num", "note_seq", "note_dur", "note_slur")


# -- item contract ----------------------------------------------------------------


def item_rules(items: DataFrame, tolerance: float = 1 / fn.SAMPLE_RATE, allowed: Sequence[str] | None = None) -> dict[str, Column]:
    """Rules of the score-item contract over sequence strings; a rule that holds is an issue."""
    have = set(items.columns)
    col = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    ph, notes = fn.tokens(col("ph_seq")), fn.tokens(col("note_seq"))
    ph_num, slur = fn.integers(col("ph_num")), fn.integers(col("note_slur"))
    dur, ph_dur = fn.numbers(col("note_dur")), fn.numbers(col("ph_dur"))
    some = lambda a: F.size(a) > 0
    rules = {f"MISSING_FIELD:{c}": (col(c).isNull() if c in have else F.lit(True)) for c in REQUIRED}
    rules |= {
        "PH_NUM_MISSING": some(ph) & ~some(ph_num),
        "NON_POSITIVE_PH_NUM": F.exists(ph_num, lambda v: v <= 0),
        "PH_NUM_MISMATCH": some(ph_num) & (F.aggregate(ph_num, F.lit(0).cast("bigint"), lambda a, v: a + v) != F.size(ph)),
        "NOTE_SEQUENCE_MISMATCH": (F.size(notes) != F.size(dur)) | (F.size(notes) != F.size(slur)),
        "UNKNOWN_NOTE_SLUR": F.exists(slur, lambda v: ~v.isin(0, 1)),
        "NOTE_SLUR_FIRST_INVALID": some(notes) & some(slur) & (F.try_element_at(slur, F.lit(1)) != 0),
        "NOTE_SLUR_WORD_MISMATCH": some(ph_num) & some(slur) & (F.size(F.filter(slur, lambda v: v == 0)) != F.size(ph_num)),
        "NON_POSITIVE_NOTE_DURATION": F.exists(dur, lambda v: v <= 0),
    }
    if "ph_dur" in have:
        given = F.col("ph_dur").isNotNull()
        gap = F.abs(fn.total(ph_dur) - fn.total(dur))
        # The larger of the relative (1e-9) and the absolute tolerance decides.
        near = F.greatest(F.greatest(fn.total(ph_dur), fn.total(dur)) * 1e-9, F.lit(tolerance))
        rules |= {
            "PH_DURATION_MISMATCH": given & (F.size(ph_dur) != F.size(ph)),
            "NON_POSITIVE_PH_DURATION": given & F.exists(ph_dur, lambda v: v <= 0),
            "DURATION_TOTAL_MISMATCH": given & some(ph_dur) & some(dur) & (gap > near),
        }
    if "f0_seq" in have:
        step = col("f0_timestep").try_cast("double")
        rules |= {
            "EMPTY_F0": F.col("f0_seq").isNotNull() & ~some(fn.numbers(col("f0_seq"))),
            "F0_TIMESTEP_INVALID": F.col("f0_seq").isNotNull() & F.coalesce(step <= 0, F.lit(True)),
        }
    if allowed:
        rules["UNKNOWN_PHONEME"] = F.exists(ph, lambda p: ~p.isin(*allowed))
    return rules


def item_issues(items: DataFrame, key: str, **options) -> DataFrame:
    """One row ``(key, type)`` per violated rule."""
    rules = item_rules(items, **options)
    found = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))
    return items.select(key, F.explode(found).alias("type"))


# The columns of a training table, in their order.
TRAINING_COLUMNS = ("name", "ph_seq", "ph_dur", "ph_num", "note_seq", "note_dur")


def normalize_items(items: DataFrame, name: str, offset: float) -> DataFrame:
    """Score items in one form: absent fields filled, blank runs single, numbers in ten digits.

    A null counts as absent. Absent label and note sequences become empty, absent phone
    durations and pitches stay absent. Other columns are kept.
    """
    have = set(items.columns)
    text = lambda c, default: F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in have else F.lit(default)
    number = lambda c, default: F.coalesce(F.col(c).try_cast("double"), F.lit(default)) if c in have else F.lit(default)
    out = {"name": text("name", name), "offset": number("offset", float(offset)), "text": text("text", ""), "lang": text("lang", "ja")}
    for c in ("ph_seq", "ph_num", "note_seq", "note_dur", "note_slur"):
        out[c] = F.array_join(fn.tokens(F.col(c) if c in have else F.lit(None).cast("string")), " ")
    for c in {"ph_dur", "f0_seq"} & have:
        out[c] = F.when(F.col(c).isNotNull(), F.array_join(F.transform(fn.numbers(F.col(c)), lambda v: fn.short_number(v)), " "))
    if "f0_seq" in have:
        out["f0_timestep"] = F.when(F.col("f0_seq").isNotNull(), number("f0_timestep", 0.01))
    return items.withColumns(out)


def training_columns(items: DataFrame) -> DataFrame:
    """The official columns as texts; what an item lacks is empty."""
    have = set(items.columns)
    return items.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in TRAINING_COLUMNS])


def element_contract(elements: DataFrame, item: str, order: Sequence[str]) -> DataFrame:
    """The item contract over one row per note: no array is built, so item size does not matter."""
    at = F.struct(*order)
    sums = elements.groupBy(item).agg(
        F.count(F.lit(1)).alias("note_count"), F.sum("note_dur").alias("note_total"), F.sum("ph_dur").alias("ph_total"),
        F.min_by("note_slur", at).alias("first_slur"), F.count_if(F.col("note_slur") == 0).alias("words"),
        F.count_if(F.col("note_dur") <= 0).alias("bad_notes"), F.count_if(F.col("ph_dur") <= 0).alias("bad_phones"),
    )
    rules = {
        "NOTE_SLUR_FIRST_INVALID": F.col("first_slur") != 0, "NON_POSITIVE_NOTE_DURATION": F.col("bad_notes") > 0,
        "NON_POSITIVE_PH_DURATION": F.col("bad_phones") > 0, "DURATION_TOTAL_MISMATCH": F.col("note_total") != F.col("ph_total"),
    }
    return sums.withColumn("issues", all_reasons(rules))


def running_offsets(elements: DataFrame, item: str, order: Sequence[str], hot=None) -> DataFrame:
    """Offset of every note and phone inside its item."""
    zero = F.lit(0).cast("bigint")
    rows = scan(
        elements, [item], order,
        [running_sum("note_offset", F.col("note_dur"), inclusive=False), running_sum("ph_offset", F.col("ph_dur"), inclusive=False)], hot,
    )
    return rows.withColumns({c: F.coalesce(c, zero) for c in ("note_offset", "ph_offset")})


def slur_flags(elements: DataFrame, item: str, order: Sequence[str], unit: str, rest: Column, hot=None) -> DataFrame:
    """1 for a note that continues the unit of the note before it; rests and new units give 0."""
    lyric = F.when(~rest & (F.col(unit) != ""), F.col(unit))
    rows = scan(elements, [item], order, [previous("__unit", lyric)], hot)
    return rows.withColumn("slur", F.when(lyric == F.col("__unit"), 1).otherwise(0).cast("bigint")).drop("__unit")


def reconcile_length(durations: Column, target: Column, tolerance: float) -> Column:
    """Let the last positive element absorb a small total difference; larger ones stay."""
    gap = target - fn.total(durations)
    spots = F.transform(durations, lambda v, i: F.when(v > 0, i))
    last = F.array_max(F.filter(spots, lambda i: i.isNotNull()))
    fixed = F.transform(durations, lambda v, i: F.when(i == last, v + gap).otherwise(v))
    ok = (F.abs(gap) <= tolerance) & last.isNotNull() & F.forall(F.filter(fixed, lambda v, i: i == last), lambda v: v > 0)
    return F.when(ok, fixed).otherwise(durations)


def phone_alignment_issues(labels: Column, expected: Column, starts: Column, ends: Column) -> Column:
    """Contract of an alignment: no unknown label, labels equal the expected ones, positive lengths."""
    tests = {
        "MFA_FORBIDDEN_PHONE": F.array_contains(labels, "spn"),
        "MFA_PHONE_SEQUENCE_MISMATCH": labels != expected,
        "MFA_NON_POSITIVE_PHONE_DURATION": F.exists(F.zip_with(starts, ends, lambda s, e: fn.to_sample(e) - fn.to_sample(s)), lambda d: d <= 0),
    }
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))


# -- phrase timing ----------------------------------------------------------------


def phrase_timing(notes: DataFrame, phones: DataFrame, keys: Sequence[str], eps=0, hot=None) -> DataFrame:
    """Phone total against note total and score span per phrase, with inner gaps and overlaps.

    ``notes``: keys, note_index, start_us, end_us. ``phones``: keys, ph_total. A phrase that
    only one side knows stays, with totals of 0 for the other and no score borders without notes.
    """
    keys = list(keys)
    gap = F.col("start_us") - F.col("__left")
    paired = scan(notes, keys, ["note_index"], [previous("__left", F.col("end_us"))], refine(hot, notes, keys))
    sums = paired.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("note_count"),
        F.sum(F.greatest(F.col("end_us") - F.col("start_us"), F.lit(0))).alias("note_total"),
        F.min("start_us").alias("score_start"), F.max("end_us").alias("score_end"),
        F.count_if(gap > eps).alias("gaps"), F.count_if(gap < -eps).alias("overlaps"),
        F.coalesce(F.max(F.when(gap > eps, gap)), F.lit(0)).cast("bigint").alias("max_gap"),
    )
    rows = sums.join(phones, keys, "full").fillna(0, ["note_count", "note_total", "gaps", "overlaps", "max_gap", "ph_total"])
    rows = rows.withColumn("score_span", F.coalesce(F.col("score_end") - F.col("score_start"), F.lit(0).cast("bigint")))
    off = (F.abs(F.col("ph_total") - F.col("note_total")) > eps) | (F.abs(F.col("ph_total") - F.col("score_span")) > eps) | (F.col("overlaps") > 0)
    return rows.withColumns(
        {
            "total_ratio": F.when(F.col("note_total") > eps, F.round(F.col("ph_total") / F.col("note_total"), 6)),
            "span_ratio": F.when(F.col("score_span") > eps, F.round(F.col("ph_total") / F.col("score_span"), 6)),
            "mismatch": off,
            "confidence": F.when(off | (F.col("gaps") > 0), "low").otherwise("high"),
            "repair_status": F.when(off, "REVIEW_REQUIRED").otherwise("ALIGNED"),
        }
    )


def index_issues(phrases: DataFrame, claims: DataFrame, notes: DataFrame, song: str = "song_id", phrase: str = "phrase") -> DataFrame:
    """Phrases that name no source note, and named indices the song does not have.

    ``claims``: song, phrase, note_index. Indices of a song run from 0; a song without notes
    has none. One row per phrase (MISSING, index null) or per phrase and index (INVALID).
    """
    size = notes.groupBy(song).agg(F.count(F.lit(1)).alias("__size"))
    named = claims.where(F.col("note_index").isNotNull()).select(song, phrase, "note_index")
    none = phrases.select(song, phrase).distinct().join(named, [song, phrase], "left_anti").select(
        song, phrase, F.lit(None).cast("bigint").alias("note_index"), F.lit("TIMING_SOURCE_NOTE_INDEX_MISSING").alias("type")
    )
    wild = named.join(size, song, "left").where((F.col("note_index") < 0) | (F.col("note_index") >= F.coalesce("__size", F.lit(0))))
    return none.unionByName(wild.select(song, phrase, "note_index", F.lit("TIMING_SOURCE_NOTE_INDEX_INVALID").alias("type")).distinct())


def index_usage(assigned: DataFrame, notes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Notes assigned more than once or not at all."""
    used = assigned.groupBy(*keys, "note_index").count()
    twice = used.where("count > 1").select(*keys, "note_index", F.lit("TIMING_DUPLICATE_SOURCE_NOTE_INDEX").alias("type"))
    free = notes.join(used, [*keys, "note_index"], "left_anti").select(*keys, "note_index", F.lit("TIMING_UNASSIGNED_SOURCE_NOTE").alias("type"))
    return twice.unionByName(free)


def rescale(notes: DataFrame, timing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stretch the notes of a phrase to its phone total, in whole units, halves to even."""
    base = timing.where("score_span > 0 and ph_total > 0").select(*keys, "score_start", "score_span", "ph_total")
    rows = notes.join(base, list(keys))
    scale = F.col("ph_total").cast("double") / F.col("score_span").cast("double")
    place = lambda c: F.col("score_start") + F.rint((F.col(c) - F.col("score_start")).cast("double") * scale).cast("bigint")
    return rows.select(
        *notes.columns, place("start_us").alias("proposed_start"), place("end_us").alias("proposed_end"), F.col("ph_total").alias("target_span")
    ).withColumn("positive", F.col("proposed_end") > F.col("proposed_start"))


def audit_draft(draft: DataFrame, keys: Sequence[str], eps=0, hot=None) -> DataFrame:
    """Re-audit a rescaled draft: positive notes, order, overlap and span per phrase."""
    keys = list(keys)
    order = ["proposed_start", "note_index"]
    rows = scan(
        draft, keys, order, [previous("__end", F.col("proposed_end")), previous("__note", F.col("note_index"))], refine(hot, draft, keys)
    )
    out = rows.groupBy(*keys).agg(
        F.count_if(F.col("proposed_end") - F.col("proposed_start") <= eps).alias("non_positive"),
        F.count_if(F.col("note_index") < F.col("__note")).alias("misordered"),
        F.count_if(F.col("proposed_start") < F.col("__end") - eps).alias("overlapping"),
        (F.max_by("proposed_end", F.struct(*order)) - F.min("proposed_start")).alias("span"), F.max("target_span").alias("target_span"),
    )
    bad = F.col("non_positive") + F.col("misordered") + F.col("overlapping") > 0
    return out.withColumn("status", F.when(bad | (F.abs(F.col("span") - F.col("target_span")) > eps), "BLOCKED").otherwise("PASS"))


def expand_spans(spans: DataFrame, hot=None, tol: int = 1) -> DataFrame:
    """Fit spoken spans to their score range and bridge voiced gaps between phrases.

    ``spans``: song_id, entry_index, start, end, score_start, score_end and the evidence
    status for each side: lead_status, trail_status, bridge_status. A span is cut back to
    the score freely and grows only on vocal evidence. ``scale`` is the factor for phone
    durations.
    """
    vocal = lambda c: F.coalesce(F.col(c) == "VOCAL_EVIDENCE", F.lit(False))
    unsure = lambda c: F.col(c).isin("EVIDENCE_INSUFFICIENT", "EVIDENCE_UNAVAILABLE")
    start, end = F.col("start"), F.col("end")
    late, early = start > F.col("score_start") + tol, end + tol < F.col("score_end")
    fitted = spans.withColumns(
        {
            "new_start": F.when((start < F.col("score_start")) | (late & vocal("lead_status")), F.col("score_start")).otherwise(start),
            "fit_end": F.when((end > F.col("score_end")) | (early & vocal("trail_status")), F.col("score_end")).otherwise(end),
        }
    )
    rows = scan(fitted, ["song_id"], ["entry_index"], [following("next_start", F.col("new_start"))], hot)
    hole = F.col("next_start") - F.col("fit_end") > tol
    review = F.when(late & unsure("lead_status"), "leading").when(early & unsure("trail_status"), "trailing").when(hole & unsure("bridge_status"), "bridge")
    out = rows.withColumn("new_end", F.when(hole & vocal("bridge_status"), F.col("next_start")).otherwise(F.col("fit_end")))
    return out.withColumns(
        {"review": review, "scale": F.round((F.col("new_end") - F.col("new_start")) / F.nullif(end - start, F.lit(0)), 6)}
    ).drop("next_start", "fit_end")


def fill_spans(segments: DataFrame, hot=None, tol: int = 0) -> DataFrame:
    """Make the notes of each span continuous: overlaps are trimmed, gaps go to a neighbour.

    ``segments``: song_id, span_index, span_start, span_end, note_index, seg_start, seg_end.
    A gap before the first note goes to that note, every other gap to the note before it.
    """
    keys, order = ["song_id", "span_index"], ["seg_start", "seg_end", "note_index"]
    hot_spans = refine(hot, segments, keys)
    reach = scan(segments, keys, order, [running_max("__reach", F.col("seg_end"))], hot_spans)
    cursor = F.greatest("span_start", "__reach")
    rows = reach.withColumn("start", F.when(F.col("seg_start") < cursor - tol, cursor).otherwise(F.col("seg_start")))
    rows = rows.withColumn("trimmed", F.col("start") != F.col("seg_start")).where("seg_end > start")
    both = scan(rows, keys, order, [previous("__before", F.col("start")), following("__next", F.col("start"))], hot_spans)
    first = F.col("__before").isNull()
    lead = first & (F.col("start") > F.col("span_start") + tol)
    inner = F.col("__next") > F.col("seg_end") + tol
    tail = F.col("__next").isNull() & (F.col("seg_end") < F.col("span_end") - tol)
    action = F.concat_ws(
        ",", F.when(F.col("trimmed"), "TRIMMED_OVERLAP"), F.when(lead, "COLLAPSED_LEADING_GAP"), F.when(inner, "COLLAPSED_INTERNAL_GAP"),
        F.when(tail, "COLLAPSED_TRAILING_GAP"),
    )
    return both.select(
        *keys, "span_start", "span_end", "note_index",
        F.when(lead, F.col("span_start")).otherwise(F.col("start")).alias("start"),
        F.when(inner, F.col("__next")).when(tail, F.col("span_end")).otherwise(F.col("seg_end")).alias("end"),
        action.alias("action"),
    )


def audit_filled(filled: DataFrame, hot=None, tol: int = 1) -> DataFrame:
    """Per span: start and end as expected, no gap, overlap or empty note inside."""
    keys = ["song_id", "span_index"]
    rows = scan(filled, keys, ["start", "note_index"], [running_max("__reach", F.col("end"))], refine(hot, filled, keys))
    cursor = F.greatest("span_start", "__reach")
    out = rows.groupBy(*keys).agg(
        F.max("span_start").alias("span_start"), F.max("span_end").alias("span_end"), F.count(F.lit(1)).alias("notes"),
        F.min("start").alias("first"), F.max("end").alias("last"), F.sum(F.col("end") - F.col("start")).alias("note_total"),
        F.count_if(F.col("end") <= F.col("start")).alias("non_positive"),
        F.count_if((F.col("start") < cursor - tol) | (F.col("start") > cursor + tol)).alias("breaks"),
    )
    ends = (F.abs(F.col("first") - F.col("span_start")) <= tol) & (F.abs(F.col("last") - F.col("span_end")) <= tol)
    clean = ends & (F.col("non_positive") == 0) & (F.col("breaks") == 0)
    return out.withColumn("status", F.when(clean, "PASS").otherwise("BLOCKED")).drop("first", "last")


# -- rests ------------------------------------------------------------------------


def beside_rests(elements: DataFrame, keys: Sequence[str], midi: Column, failed: Column, hot, *stages) -> DataFrame:
    """Side of the nearest non-rest neighbour in pitch per failed rest; right wins ties."""
    note = F.when(F.col("kind") == "note", F.struct("element", "pitch"))
    dl, dr = F.abs(midi - F.col("l.pitch")), F.abs(midi - F.col("r.pitch"))
    right = F.col("r").isNotNull() & (F.col("l").isNull() | dr.isNull() | (dr <= dl))
    side = F.when((F.col("kind") == "rest") & failed & (F.col("l").isNotNull() | F.col("r").isNotNull()), F.when(right, "right").otherwise("left"))
    rows = scan(elements, keys, ["element"], [last_seen("l", note), next_seen("r", note)], refine(hot, elements, keys), *[make(side) for make in stages])
    return rows.withColumn("side", side)


def rest_targets(elements: DataFrame, keys: Sequence[str], midi: Column, hot=None) -> DataFrame:
    """For each rest the non-rest neighbour nearest in pitch; the right one wins ties.

    ``elements``: keys, element, kind, pitch. ``midi`` is the pitch heard in the rest, or null.
    """
    rows = beside_rests(elements, keys, midi, F.lit(True), hot).where("kind = 'rest'")
    target = F.when(F.col("side") == "right", F.col("r.element")).when(F.col("side") == "left", F.col("l.element"))
    return rows.select(*keys, "element", target.alias("target"), "side", (F.col("end_us") - F.col("start_us")).alias("moved"))


def absorb_rests(elements: DataFrame, keys: Sequence[str], midi: Column, failed: Column, hot=None) -> DataFrame:
    """Note durations after failed rests went to their neighbours.

    Rests fill whole gaps, so a note can only take the rest right before and right after
    it: one more pass over the same order, no join.
    """
    moved = F.col("end_us") - F.col("start_us")
    near = lambda side: [previous("__p", F.struct(side.alias("side"), moved.alias("len"))), following("__f", F.struct(side.alias("side"), moved.alias("len")))]
    rows = beside_rests(elements, keys, midi, failed, hot, near).where("kind = 'note'")
    extra = F.when(F.col("__p.side") == "right", F.col("__p.len")).otherwise(0) + F.when(F.col("__f.side") == "left", F.col("__f.len")).otherwise(0)
    return rows.select(*keys, "element", "note_index", (moved + extra).alias("note_dur"), extra.alias("absorbed"))
