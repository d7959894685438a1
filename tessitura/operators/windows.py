"""Notes against training windows: audit, coverage, rests, prune budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import intervals as iv
from .scans import HotKeys, Scan, following, previous, refine, row_number, running_sum, scan

SONG = ["song_id"]


def audit_notes(notes: DataFrame, windows: DataFrame, eps=0, hot: HotKeys | None = None) -> DataFrame:
    """Status of every note: contained, cut, outside or invalid, with its window counts.

    Windows a note touches are counted by rank: those that start before its end less those
    that end before its start, both running counts over one ordered stream. The one window
    of a note that touches just one is the window with the latest end among those that start
    before the note ends. No note meets its windows, so crowded songs stay linear.
    ``inside`` is 1 for a note wholly inside the only window it touches. Windows of no
    length touch nothing (``audit_windows`` reports them).
    """
    spans = windows.where(F.col("end_us") - F.col("start_us") > 2 * eps).select("song_id", F.col("start_us").alias("w_start"), F.col("end_us").alias("w_end"))
    good = notes.where("end_us > start_us").select("song_id", "note_index", "start_us", "end_us")
    one = F.lit(1).cast("bigint")

    def event(at: Column, rank: int, side: str | None = None, **counts: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(rank).alias("rank"), F.lit(side).cast("string").alias("side"), *[counts.get(c, F.lit(0).cast("bigint")).alias(c) for c in ("starts", "ends")])

    def stream(rows: DataFrame, *events: Column) -> DataFrame:
        return rows.select("*", F.explode(F.array(*events)).alias("e")).select(*rows.columns, "e.*")

    # At one place ends come first, then notes, then starts: a window must end at or before, or start before.
    marks = stream(spans, event(F.col("w_end"), 0, ends=one), event(F.col("w_start"), 2, starts=one))
    borders = stream(good, event(F.col("start_us") + eps, 1, "a"), event(F.col("end_us") - eps, 1, "b"))
    last = F.when(F.col("rank") == 2, F.struct("w_end", "w_start"))
    rows = scan(
        marks.unionByName(borders, allowMissingColumns=True), SONG, ["at", "rank", "side", "note_index", "w_start", "w_end"],
        [running_sum("__starts", F.col("starts")), running_sum("__ends", F.col("ends")), Scan("__last", "max", last)], hot,
    ).where("rank = 1")
    at_end = lambda c: F.max(F.when(F.col("side") == "b", F.col(c)))
    counted = rows.groupBy("song_id", "note_index").agg(
        (at_end("__starts") - F.max(F.when(F.col("side") == "a", F.col("__ends")))).alias("hits"), at_end("__last").alias("w"),
        F.max("start_us").alias("start_us"), F.max("end_us").alias("end_us"),
    )
    within = (F.col("hits") == 1) & (F.col("start_us") >= F.col("w.w_start") - eps) & (F.col("end_us") <= F.col("w.w_end") + eps)
    counted = counted.select("song_id", "note_index", "hits", F.when(within, 1).otherwise(0).cast("bigint").alias("inside"))
    status = F.when(F.col("inside") == 1, "contained").when(F.col("hits") > 0, "cut").otherwise("outside")
    zero = F.lit(0).cast("bigint")
    bad = notes.where("end_us <= start_us").select("song_id", "note_index", zero.alias("hits"), zero.alias("inside"), F.lit("invalid").alias("status"))
    return counted.withColumn("status", status).unionByName(bad)


def empty_windows(notes, windows, eps=0, hot=None) -> DataFrame:
    """Windows that no note touches."""
    touched = iv.overlapping_any(windows, iv.union(notes, SONG, eps, hot=hot), SONG, eps, hot=hot)
    return touched.where("not overlaps").drop("overlaps")


def audit_windows(windows: DataFrame, eps=0, hot=None) -> DataFrame:
    """Inverted windows and windows that overlap the one before them."""
    bad = windows.where("end_us <= start_us").select(
        "song_id", "clip_id", F.lit("INVALID_SCORE_WINDOW").alias("type"), F.lit(None).cast("string").alias("previous_clip_id")
    )
    order = ["start_us", "end_us", "clip_id"]
    paired = scan(windows, SONG, order, [previous("p", F.struct("clip_id", "end_us"))], hot)
    over = paired.where(F.col("start_us") < F.col("p.end_us") - eps).select(
        "song_id", "clip_id", F.lit("OVERLAPPING_SCORE_WINDOWS").alias("type"), F.col("p.clip_id").alias("previous_clip_id")
    )
    return bad.unionByName(over)


def song_audit(notes, windows, eps=0, hot=None) -> DataFrame:
    """Per-song counts of the note/window audit with PASS or REVIEW_REQUIRED."""
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    names = ["note_count", "contained", "cut", "outside", "invalid", "window_count", "empty_windows", "window_issues"]

    def facts(rows: DataFrame, **given: Column) -> DataFrame:
        return rows.select("song_id", *[given.get(n, zero).alias(n) for n in names])

    def is_(status: str) -> Column:
        return F.when(F.col("status") == status, 1).otherwise(0).cast("bigint")

    per_note = audit_notes(notes, windows, eps, hot)
    parts = [
        facts(per_note, note_count=one, **{s: is_(s) for s in ("contained", "cut", "outside", "invalid")}),
        facts(windows, window_count=one),
        facts(empty_windows(notes, windows, eps, hot), empty_windows=one),
        facts(audit_windows(windows, eps, hot), window_issues=one),
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    counted = rows.groupBy("song_id").agg(*[F.sum(n).alias(n) for n in names])
    problems = F.col("cut") + F.col("invalid") + F.col("empty_windows") + F.col("window_issues")
    return counted.withColumn("status", F.when(problems == 0, "PASS").otherwise("REVIEW_REQUIRED"))


def coverage_contract(windows, exclusions, observed, eps=0, hot=None) -> DataFrame:
    """Expected (accepted minus excluded) against observed coverage, piece by piece.

    Pieces are compared by position within a song, within ``eps`` at both ends.
    """
    expected = iv.subtract(windows, exclusions, SONG, eps, hot=hot)
    seen = iv.union(observed, SONG, eps, hot=hot)

    def numbered(rows: DataFrame, side: str) -> DataFrame:
        n = scan(rows, SONG, ["start_us", "end_us"], [row_number("piece")], hot)
        return n.select("song_id", "piece", F.col("start_us").alias(f"{side}_start"), F.col("end_us").alias(f"{side}_end"))

    both = numbered(expected, "expected").join(numbered(seen, "observed"), ["song_id", "piece"], "full_outer")
    near = (F.abs(F.col("expected_start") - F.col("observed_start")) <= eps) & (
        F.abs(F.col("expected_end") - F.col("observed_end")) <= eps
    )
    state = F.when(F.col("expected_start").isNull(), "UNEXPECTED").when(F.col("observed_start").isNull(), "MISSING")
    return both.withColumn("state", state.when(near, "EQUAL").otherwise("DIFFERENT"))


def prune_budget(exclusions, windows, max_ratio_percent: int, carried_us: int = 0, eps=0, hot=None) -> DataFrame:
    """Excluded time (overlaps once) against a percentage of the accepted time, over the whole set.

    One row per song with windows or cuts holds the song's own sums; status and ratio, the
    same in all rows, compare the set's one sum of cuts and the carried amount, once, with
    the share of the set's total.
    """
    cut = iv.union(exclusions, SONG, eps, hot=hot).groupBy("song_id").agg(
        F.sum(F.col("end_us") - F.col("start_us")).alias("pruned_us"), F.count(F.lit(1)).alias("pieces")
    )
    total = windows.groupBy("song_id").agg(F.sum(F.greatest(F.lit(0), F.col("end_us") - F.col("start_us"))).alias("total_us"))
    songs = total.join(cut, "song_id", "full").fillna(0, ["pruned_us", "pieces", "total_us"])
    whole = songs.groupBy().agg(F.sum("pruned_us").alias("set_pruned_us"), F.sum("total_us").alias("set_total_us"))
    judged = with_budget(whole, max_ratio_percent, carried_us, eps).withColumn("__set", F.lit(0))
    return songs.withColumn("__set", F.lit(0)).join(F.broadcast(judged), "__set").drop("__set")


def with_budget(rows: DataFrame, max_ratio_percent: int, carried_us: int = 0, eps=0) -> DataFrame:
    """Status and ratio of ``set_pruned_us`` to ``set_total_us``; compared in whole units, so without rounding."""
    # Times a hundred, the sum of a large set leaves the range of a bigint.
    spent = (F.col("set_pruned_us").cast("decimal(20,0)") + carried_us) * 100
    allowed = F.col("set_total_us").cast("decimal(20,0)") * max_ratio_percent
    return rows.withColumn("status", F.when(spent <= allowed + eps * 100, "WITHIN_BUDGET").otherwise("BLOCKED_PRUNE_BUDGET")).withColumn(
        "prune_ratio", F.when(F.col("set_total_us") > 0, F.round((F.col("set_pruned_us") + carried_us) / F.col("set_total_us"), 6)).otherwise(F.lit(1.0))
    )


def phrase_chunks(notes, min_gap: int, order=("start_us", "note_index"), hot=None) -> DataFrame:
    """Split the notes of a song where the silence before a note is at least ``min_gap``."""
    fresh = F.when(F.col("start_us") - F.col("__left") >= min_gap, 1).otherwise(0)
    cut = scan(notes, SONG, list(order), [previous("__left", F.col("end_us"))], hot, [running_sum("chunk_index", fresh)])
    return cut.groupBy("song_id", "chunk_index").agg(
        F.count(F.lit(1)).alias("note_count"), F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us")
    )


def plan_pieces(windows, exclusions, min_piece: int, eps=0, hot=None):
    """Accepted pieces after exclusions, with the short-residual rule.

    If an exclusion leaves a window with a piece under ``min_piece``, that window is kept
    whole and its exclusions come back as pause candidates. Windows must be disjoint
    (``audit_windows`` reports those that are not).

    Returns ``(pieces, pause_candidates, effective_exclusions)``. Pieces and pauses come from
    one sweep and one scan; the facts about a window are forward and backward sums over
    its own parts.
    """
    cuts = iv.union(exclusions, SONG, eps, hot=hot)
    base = windows.select("song_id", "clip_id", "start_us", "end_us", F.col("start_us").alias("w_from"), F.col("end_us").alias("w_to"))
    parts = iv.subtract_disjoint(base, cuts, SONG, eps, hot=hot, carry=["clip_id", "w_from", "w_to"])
    size = F.col("end_us") - F.col("start_us")
    keys = ["song_id", "clip_id"]
    rows = scan(
        parts, keys, ["start_us"],
        [
            running_sum("__s1", size), Scan("__s2", "sum", size, reverse=True),
            Scan("__m1", "min", size, inclusive=True), Scan("__m2", "min", size, inclusive=True, reverse=True),
            previous("__left", F.col("end_us")), following("__right", F.col("start_us")),
        ],
        refine(hot, parts, keys),
    )
    kept = F.col("__s1") + F.coalesce("__s2", F.lit(0))
    whole = (F.least("__m1", "__m2") < min_piece - eps) & (F.col("w_to") - F.col("w_from") - kept > eps)
    first, last = F.col("__left").isNull(), F.col("__right").isNull()
    pieces = rows.where(~whole | first).select(
        *keys, F.when(whole, F.col("w_from")).otherwise(F.col("start_us")).alias("start_us"), F.when(whole, F.col("w_to")).otherwise(F.col("end_us")).alias("end_us")
    )
    before = F.struct(F.coalesce("__left", "w_from").alias("a"), F.col("start_us").alias("b"))
    after = F.when(last, F.struct(F.col("end_us").alias("a"), F.col("w_to").alias("b")))
    pauses = rows.where(whole).select(*keys, F.explode(F.array_compact(F.array(before, after))).alias("p")).where(F.col("p.b") - F.col("p.a") > eps)
    pauses = pauses.select(*keys, F.col("p.a").alias("start_us"), F.col("p.b").alias("end_us"))
    effective = iv.subtract(exclusions, pauses, SONG, eps, hot=hot)
    return pieces, pauses, effective


def window_elements(pieces, notes, eps=0, hot: HotKeys | None = None) -> DataFrame:
    """Notes wholly inside a piece plus the rests that fill it, in order.

    Notes must not overlap each other. One row per element: kind note or rest. A piece
    without a note gives no element (``segment_plan`` reports it). One as-of lookup and one
    scan: every note emits the rest before it, and the last one the rest after it.
    """
    marks = pieces.select("song_id", "clip_id", F.col("start_us").alias("p_start"), F.col("end_us").alias("p_end"))
    probes = notes.where("end_us > start_us").withColumn("__limit", F.col("start_us") + eps)
    found = iv.asof(probes, marks, SONG, "__limit", "p_start", ["clip_id", "p_start", "p_end"], hot=hot)
    inside = found.where(F.col("end_us") <= F.col("mark.p_end") + eps).select(
        "song_id", F.col("mark.clip_id").alias("clip_id"), F.col("mark.p_start").alias("piece_start"), F.col("mark.p_end").alias("piece_end"),
        "note_index", "pitch", "start_us", "end_us",
    )
    keys, order = ["song_id", "clip_id", "piece_start"], ["start_us", "end_us"]
    open_from = F.coalesce("__left", "piece_start")
    lead = F.col("start_us") - open_from > eps
    tail = F.col("__right").isNull() & (F.col("piece_end") - F.col("end_us") > eps)
    emitted = 1 + F.when(lead, 1).otherwise(0) + F.when(tail, 1).otherwise(0)
    rows = scan(
        inside, keys, order, [previous("__left", F.col("end_us")), following("__right", F.col("start_us"))], refine(hot, inside, keys),
        [running_sum("__upto", emitted.cast("bigint"))],
    )
    none = F.lit(None).cast("bigint")

    def element(kind: str, place: Column, begin: Column, end: Column) -> Column:
        note = kind == "note"
        return F.struct(
            F.lit(kind).alias("kind"), (F.col("note_index") if note else none).alias("note_index"), (F.col("pitch").cast("bigint") if note else none).alias("pitch"),
            begin.alias("start_us"), end.alias("end_us"), place.cast("bigint").alias("element"),
        )

    at = F.col("__upto") - F.when(tail, 1).otherwise(0)
    parts = F.array(
        F.when(lead, element("rest", at - 1, open_from, F.col("start_us"))),
        element("note", at, F.col("start_us"), F.col("end_us")),
        F.when(tail, element("rest", at + 1, F.col("end_us"), F.col("piece_end"))),
    )
    return rows.select(*keys, F.explode(F.array_compact(parts)).alias("e")).select(*keys, "e.*")


def split_over_spans(notes, spans, bin_us: int, min_piece: int, hot=None) -> DataFrame:
    """Cut notes at span borders; a note that would leave a sliver goes whole to one span.

    ``spans`` has ``song_id, span_index, span_start, span_end``. When a note overlaps
    several spans and any overlap is under ``min_piece``, only the largest overlap (the
    earlier span on ties) is kept.
    """
    touches = (F.col("end_us") > F.col("span_start")) & (F.col("start_us") < F.col("span_end"))
    pairs = iv.overlap_join(notes, spans, SONG, bin_us, touches, ("start_us", "end_us"), ("span_start", "span_end"))
    pairs = pairs.select(
        *notes.columns, "span_index", "span_start", "span_end",
        F.greatest("start_us", "span_start").alias("seg_start"), F.least("end_us", "span_end").alias("seg_end"),
    ).withColumn("overlap", F.col("seg_end") - F.col("seg_start"))
    key, rank = ["song_id", "note_index"], F.struct("overlap", -F.col("span_index"))
    both_ways = lambda name, op, value: [Scan(f"__{name}1", op, value, inclusive=True), Scan(f"__{name}2", op, value, reverse=True)]
    steps = [*both_ways("n", "sum", F.lit(1)), *both_ways("min", "min", F.col("overlap")), *both_ways("best", "max", rank)]
    seen = scan(pairs, key, ["span_index"], steps, refine(hot, pairs, key))
    several = F.col("__n1") + F.coalesce("__n2", F.lit(0)) > 1
    whole = several & (F.least("__min1", "__min2") < min_piece)
    cut = (F.col("seg_start") != F.col("start_us")) | (F.col("seg_end") != F.col("end_us"))
    return seen.where(~whole | (rank == F.greatest("__best1", "__best2"))).select(
        "song_id", "note_index", "span_index", "span_start", "span_end", "seg_start", "seg_end", cut.alias("split")
    )
