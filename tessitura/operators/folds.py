"""Rules in which every decision depends on the one before.

``fold`` streams the ordered rows of each key through such a rule with a small state: the
rows are shuffled by key, sorted, and passed in Arrow batches, so no group is held in
memory. A hot key is cut into chunks that run side by side: every
chunk first assumes it starts fresh, then chunks whose true incoming state differs run
again until no state changes, and only then are rows produced. The driver holds one small
state per chunk, never rows. The result equals the sequential run.

The per-row functions are a few lines each; Spark orders, groups and distributes the rows.
"""

from __future__ import annotations

import itertools
import json
import logging
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .intervals import asof, overlap_join, union
from .scans import CHUNK, HotKeys, Scan, assign_chunks, find_hot_keys, next_seen, previous, refine, row_number, running_sum, scan
from .stats import percentiles

# A rule takes (rows in order, state or None, is this the end) and yields output tuples;
# its return value is the state after the last row.
Rule = Callable[[Iterator, dict | None, bool], Iterator]


FLUSH_ROWS = 20_000
log = logging.getLogger(__name__)


def _null(value):
    return None if value is None or value != value else value


def _streamed(rule: Rule, n_keys: int, names: list[str], only_state: bool):
    """A partition function: rows sorted by group stream through the rule, one group after another.

    Columns come as keys, chunk, incoming state, is-last flag, then the rule's columns.
    Nothing is held but the state and a small output buffer.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for b in batches for r in b.itertuples(index=False))
        out: list[tuple] = []
        for group, members in itertools.groupby(rows, key=lambda r: tuple(_null(v) for v in r[: n_keys + 1])):
            first = next(members)
            entering, last = _null(first[n_keys + 1]), bool(first[n_keys + 2])
            steps = rule(itertools.chain([first], members), json.loads(entering) if entering else None, last)
            while True:
                try:
                    row = next(steps)
                except StopIteration as done:
                    if only_state:
                        out.append((*group, json.dumps(done.value)))
                    break
                if not only_state:
                    out.append((*group[:n_keys], *row))
                if len(out) >= FLUSH_ROWS:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return run


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], rule: Rule, schema: str, hot: HotKeys | None = None) -> DataFrame:
    """Apply ``rule`` along the order of each key; output has the keys and ``schema``."""
    ship_package(df.sparkSession)
    keys, order = list(keys), list(order)
    hot = find_hot_keys(df, keys) if hot is None else hot
    key_fields = [df.schema[k] for k in keys]
    fields = T.StructType([*key_fields, *T._parse_datatype_string(schema).fields])
    n, data = len(keys), [c for c in df.columns if c not in keys]
    meta = [F.col(CHUNK).alias("chunk_"), F.col("__in").alias("in_"), F.col("__last").alias("last_")]

    def through(rows: DataFrame, names: list[str], out: T.StructType, only_state: bool) -> DataFrame:
        ready = rows.select(*keys, *meta, *data).repartition(*keys, "chunk_").sortWithinPartitions(*keys, "chunk_", *order)
        return ready.mapInPandas(_streamed(rule, n, names, only_state), out)

    if not hot:
        whole = df.withColumns({CHUNK: F.lit(0), "__in": F.lit(None).cast("string"), "__last": F.lit(True)})
        return through(whole, fields.names, fields, False)

    chunks = assign_chunks(df, keys, order, hot)
    sizes = chunks.groupBy(*keys).agg(F.max(CHUNK).alias("m")).where("m > 0").collect()
    last_of = {tuple(r[:n]): r["m"] for r in sizes}
    entering: dict[tuple, str | None] = {(*k, c): None for k, m in last_of.items() for c in range(m + 1)}
    leaving: dict[tuple, str | None] = {}
    state_schema = T.StructType([*key_fields, T.StructField("c", T.IntegerType()), T.StructField("state", T.StringType())])
    table_schema = T.StructType(
        [*[T.StructField(f"__k{i}", f.dataType) for i, f in enumerate(key_fields)], T.StructField("__kc", T.IntegerType()),
         T.StructField("__in", T.StringType()), T.StructField("__last", T.BooleanType())]
    )

    def with_states(ids: list[tuple], how: str) -> DataFrame:
        table = df.sparkSession.createDataFrame([(*i, entering[i], i[-1] == last_of[i[:-1]]) for i in ids], table_schema)
        on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [F.col(CHUNK) == F.col("__kc")]
        return chunks.join(F.broadcast(table), on, how).withColumn("__last", F.coalesce("__last", F.lit(True)))

    todo = list(entering)
    while todo:
        log.debug("states of %d of %d chunks", len(todo), len(entering))
        states = through(with_states(todo, "inner").withColumn("__last", F.lit(False)), state_schema.names, state_schema, True)
        leaving.update({tuple(r[:-1]): r["state"] for r in states.collect()})
        todo = []
        for i in entering:
            before = leaving.get((*i[:-1], i[-1] - 1)) if i[-1] else None
            if before != entering[i]:
                entering[i] = before
                todo.append(i)
    return through(with_states(list(entering), "left"), fields.names, fields, False)


# -- packing ------------------------------------------------------------------------


def pack_windows(items: DataFrame, keys, rest_gap: int, min_len: int, max_len: int, hard_max: int, hot=None) -> DataFrame:
    """Greedy alignment windows: close at a rest once long enough, or when the next item would not fit.

    ``items``: keys, item, start, end (times as integers). Items are never cut; those
    without a duration are in no window and reported by ``item_issues``. The state is the
    open window alone; windows are numbered afterwards, so chunks of a hot key whose
    windows close alike agree at once.
    """

    def rule(rows, w, last):
        for r in rows:
            if r.end <= r.start:
                continue
            if w and ((r.start - w[1] >= rest_gap and w[1] - w[0] >= min_len) or r.end - w[0] > max_len):
                yield tuple(w)
                w = None
            w = [w[0], max(w[1], int(r.end)), w[2], int(r.item), w[4] + 1] if w else [int(r.start), int(r.end), int(r.item), int(r.item), 1]
        if last and w:
            yield tuple(w)
        return w

    out = fold(items.select(*keys, "item", "start", "end"), keys, ["item"], rule,
               "start long, end long, first_item long, last_item long, items long", hot)
    out = scan(out, keys, ["first_item"], [row_number("window_index")], hot)
    size = F.col("end") - F.col("start")
    issue = F.when(size > hard_max, "ALIGNMENT_WINDOW_TOO_LONG").when((size < min_len) & (F.col("items") > 1), "ALIGNMENT_DENSE_SHORT_WINDOW")
    return out.withColumn("issue", issue)


def item_issues(items: DataFrame, keys, hard_max: int) -> DataFrame:
    """Items that packing leaves out or that fill more than a window: keys, item, issue, duration."""
    size = F.col("end") - F.col("start")
    issue = F.when(F.coalesce(size, F.lit(0)) <= 0, "ALIGNMENT_ITEM_DURATION_INVALID").when(size > hard_max, "ALIGNMENT_ITEM_TOO_LONG")
    return items.select(*keys, "item", issue.alias("issue"), size.alias("duration")).where("issue is not null")


def merge_dense(items: DataFrame, keys, eps: int, short: int, dense: int, hot=None) -> DataFrame:
    """Join an item to its contiguous left neighbour when either is very short and crowded.

    ``items``: keys, item, start, duration, phones. A merged item is judged by its sums. An
    item that is dense joins the next one by the same test, seen from the right. Output
    is one row per merged item.
    """

    def rule(rows, s, last):
        crowded = lambda d, p: d < short and p > dense
        s = s or {"open": None}
        for r in rows:
            w = s["open"]
            if w and abs(r.start - (w[1] + w[2])) <= eps and (crowded(w[2], w[3]) or crowded(r.duration, r.phones)):
                s["open"] = [w[0], w[1], w[2] + int(r.duration), w[3] + int(r.phones), int(r.item), w[5] + 1]
                continue
            if w:
                yield tuple(w)
            s["open"] = [int(r.item), int(r.start), int(r.duration), int(r.phones), int(r.item), 1]
        if last and s["open"]:
            yield tuple(s["open"])
        return s

    return fold(items.select(*keys, "item", "start", "duration", "phones"), keys, ["item"], rule,
                "first_item long, start long, duration long, phones long, last_item long, members long", hot)


# -- window boundary repair -----------------------------------------------------------


def repair_candidates(notes: DataFrame, windows: DataFrame, bin_us: int, eps: int = 0) -> DataFrame:
    """Cut notes with the windows they touch: expand one window, or share a border of two.

    One row per note with the number of windows and the first and last of them in time
    order; no rule looks at more than two, so no list is kept.
    """
    keys = ["song_id"]
    spans = windows.select("song_id", "clip_id", F.col("start_us").alias("w_start"), F.col("end_us").alias("w_end"))
    good = notes.where("end_us > start_us").select("song_id", "note_index", "start_us", "end_us")
    touch = (F.col("end_us") > F.col("w_start") + eps) & (F.col("start_us") < F.col("w_end") - eps)
    pairs = overlap_join(good, spans, keys, bin_us, touch, ("start_us", "end_us"), ("w_start", "w_end"))
    inside = (F.col("start_us") >= F.col("w_start") - eps) & (F.col("end_us") <= F.col("w_end") + eps)
    hit = F.struct("w_start", "clip_id", "w_end")
    found = pairs.groupBy("song_id", "note_index", "start_us", "end_us").agg(
        F.count(F.lit(1)).alias("hits"), F.min(hit).alias("first_hit"), F.max(hit).alias("last_hit"), F.count_if(inside).alias("__in")
    ).where("not (hits = 1 and __in = 1)").drop("__in")
    one = found.where("hits = 1").select(
        "song_id", "note_index", F.least("start_us", "first_hit.w_start").alias("p_start"), F.greatest("end_us", "first_hit.w_end").alias("p_end")
    )
    clash = overlap_join(one, spans, keys, bin_us, (F.col("p_end") > F.col("w_start")) & (F.col("p_start") < F.col("w_end")), ("p_start", "p_end"), ("w_start", "w_end"))
    clash = clash.groupBy("song_id", "note_index").agg(F.count(F.lit(1)).alias("near")).where("near > 1").select("song_id", "note_index", F.lit(True).alias("clash"))
    n = F.col("hits")
    action = F.when((n == 1) & F.col("clash").isNull(), "EXPAND_SINGLE_WINDOW").when(n == 1, "REVIEW_SINGLE_WINDOW_EXPANSION")
    return found.join(clash, ["song_id", "note_index"], "left").select(
        "song_id", "note_index", "start_us", "end_us", "hits", action.when(n == 2, "SHIFT_SHARED_BOUNDARY").otherwise("REVIEW_MULTI_WINDOW_NOTE").alias("action"),
        *[F.col(f"{side}_hit.{c}").alias(f"{side}_{name}") for side in ("first", "last") for c, name in (("clip_id", "clip"), ("w_start", "start"), ("w_end", "end"))],
    )


def repair_windows(notes: DataFrame, windows: DataFrame, bin_us: int, policy: str = "majority", eps: int = 0, hot=None):
    """Apply the candidates in note order; each one sees the windows as left by the earlier ones.

    Returns (windows, decisions). The state is the set of windows a later note can still
    touch. ``policy`` is majority, left or right.
    """
    if policy not in ("majority", "left", "right"):
        raise ValueError(f"unknown policy {policy}")

    def rule(rows, s, last):
        s = s or {}
        for r in rows:
            hits = [(r.first_clip, r.first_start, r.first_end), (r.last_clip, r.last_start, r.last_end)][: min(2, r.hits)]
            a, b = int(r.start_us), int(r.end_us)
            s = {c: w for c, w in s.items() if w[1] > a or any(c == h[0] for h in hits)}
            for clip, ws, we in hits:
                s.setdefault(clip, [int(ws), int(we)])
            if r.action == "EXPAND_SINGLE_WINDOW":
                w = s[hits[0][0]]
                w[:] = [min(w[0], a), max(w[1], b)]
                yield (r.note_index, "APPLIED", hits[0][0], hits[0][0], w[0], w[1])
            elif r.action != "SHIFT_SHARED_BOUNDARY":
                yield (r.note_index, "UNRESOLVED", None, None, None, None)
            else:
                (lc, lw), (rc, rw) = sorted(((h[0], s[h[0]]) for h in hits), key=lambda x: (x[1][0], x[0]))
                lo = max(0, min(b, lw[1]) - max(a, lw[0]))
                ro = max(0, min(b, rw[1]) - max(a, rw[0]))
                if policy == "majority" and lo == ro:
                    yield (r.note_index, "UNRESOLVED", None, None, None, None)
                    continue
                left = policy == "left" or (policy == "majority" and lo > ro)
                lw[1] = rw[0] = b if left else a
                owner = lc if left else rc
                yield (r.note_index, "APPLIED", owner, lc, lw[0], lw[1])
                yield (r.note_index, "APPLIED", owner, rc, rw[0], rw[1])
        return s

    candidates = repair_candidates(notes, windows, bin_us, eps)
    schema = "note_index long, outcome string, owner string, clip_id string, new_start long, new_end long"
    decisions = fold(candidates, ["song_id"], ["note_index"], rule, schema, refine(hot, candidates, ["song_id"]))
    final = decisions.where("clip_id is not null").groupBy("song_id", "clip_id").agg(
        F.max_by(F.struct("new_start", "new_end"), "note_index").alias("n")
    )
    repaired = windows.join(final, ["song_id", "clip_id"], "left").select(
        "song_id", "clip_id", F.coalesce("n.new_start", "start_us").alias("start_us"), F.coalesce("n.new_end", "end_us").alias("end_us")
    )
    return repaired, decisions


# -- activity segments ----------------------------------------------------------------


def activity_segments(frames: DataFrame, keys, frame_sec: float = 0.03, low: float = 3.0, high: float = 12.0, hot=None) -> DataFrame:
    """Sung segments from frame levels: threshold, close short holes, pad, merge, cut, merge, keep.

    ``frames``: keys, pos (0..n-1), rms. Long stretches are cut at their quietest frame
    7 to 11 seconds after the last cut.
    """
    keys = list(keys)
    loud = percentiles(frames.where("rms > 1e-7"), keys, F.col("rms"), {"p75": ("linear", 0.75)}, hot).drop("n")
    size = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    border = F.greatest(F.lit(10 ** (-55 / 20)), F.col("p75") * 10 ** (-38 / 20))
    marked = frames.join(loud.join(size, keys), keys)
    on = marked.where(F.col("rms") > border).select(*keys, F.col("pos").alias("start_us"), (F.col("pos") + 1).alias("end_us"))
    holes = max(1, round(0.35 / frame_sec))
    raw = union(on, keys, holes, hot=hot).join(size, keys)
    spans = raw.select(
        *keys,
        F.greatest(F.lit(0.0), F.col("start_us") * frame_sec - 0.1).alias("a"),
        F.least(F.col("n") * frame_sec, F.least(F.col("n") * frame_sec, F.col("end_us") * frame_sec) + 0.1).alias("b"),
    )
    joined = _join_close(spans, keys, 0.45, high, 0.0, hot)
    long_ = joined.where(F.col("b") - F.col("a") > high)
    kept = joined.where((F.col("b") - F.col("a") <= high) & (F.col("b") - F.col("a") >= low))
    cut = _cut_long(frames, long_, keys, frame_sec, low, high, hot)
    merged = _join_close(kept.unionByName(cut), keys, 0.75, high, low, hot)
    length = F.col("b") - F.col("a")
    return merged.where((length >= low) & (length <= high)).select(*keys, F.bround("a", 3).alias("start_sec"), F.bround("b", 3).alias("end_sec"))


def _join_close(spans: DataFrame, keys, gap: float, high: float, low: float, hot=None) -> DataFrame:
    def rule(rows, s, last):
        w = s["w"] if s else None
        for r in rows:
            if w and r.a - w[1] <= gap and r.b - w[0] <= high:
                w = [w[0], float(r.b)]
            elif r.b - r.a >= low:
                if w:
                    yield tuple(w)
                w = [float(r.a), float(r.b)]
        if last and w:
            yield tuple(w)
        return {"w": w}

    return fold(spans, keys, ["a", "b"], rule, "a double, b double", refine(hot, spans, keys))


def _cut_long(frames, long_, keys, frame_sec, low, high, hot=None) -> DataFrame:
    """Cuts of stretches longer than ``high``; only their frames are read."""
    marks = long_.withColumn("__from", F.floor(F.col("a") / frame_sec))
    placed = asof(frames.select(*keys, "pos", "rms"), marks, keys, "pos", "__from", ["a", "b"], hot=hot)
    rows = placed.where((F.col("mark.a").isNotNull()) & (F.col("pos") <= F.floor(F.col("mark.b") / frame_sec))).select(
        *keys, "pos", "rms", F.col("mark.a").alias("a"), F.col("mark.b").alias("b")
    )

    def rule(frames_, s, last):
        s = s or {"a": None}
        for r in frames_:
            if s["a"] != r.a:
                s = {"a": float(r.a), "b": float(r.b), "from": float(r.a), "best": None, "at": None}
            while s["b"] - s["from"] > high:
                lower, upper = s["from"] + 7.0, min(s["from"] + 11.0, s["b"] - low)
                if upper <= lower:
                    cut = s["from"] + high
                else:
                    first = max(0, int(lower / frame_sec))
                    end = max(first + 1, int(upper / frame_sec))
                    if r.pos < first:
                        break
                    if r.pos < end:
                        if s["best"] is None or r.rms < s["best"]:
                            s["best"], s["at"] = float(r.rms), int(r.pos)
                        if r.pos < end - 1:
                            break
                    cut = (s["at"] if s["at"] is not None else first) * frame_sec
                    if cut <= s["from"] + low or cut >= s["b"] - low:
                        cut = s["from"] + high
                yield (s["from"], cut)
                # The next search starts 7 s after the cut, so no earlier frame is needed again.
                s["from"], s["best"], s["at"] = cut, None, None
            if s["b"] - s["from"] <= high and not s.get("done"):
                s["done"] = True
                if s["b"] - s["from"] >= low:
                    yield (s["from"], s["b"])
        return s

    return fold(rows, keys, ["pos"], rule, "a double, b double", refine(hot, rows, keys))


# -- note counts ----------------------------------------------------------------------


def realign_counts(phrases: DataFrame, gaps: DataFrame, hot=None) -> DataFrame:
    """Move notes after a verified rest out of a phrase into later ones with room, all or nothing.

    ``phrases``: song_id, phrase, count, phones. ``gaps``: song_id, boundary_index. Emits a
    ``count`` row per phrase and a row per gap (ALREADY_ALIGNED, REALIGNED or FAILED); a gap
    behind the last phrase has no row.

    A phrase ends at the first of: its own end, its begin plus all it can hold, the next rest
    that still leaves room for what follows. What leaves a phrase is therefore only how far
    its end lies before its own one and the rests between the two. Both are forgotten where
    the notes on the move have found room, so a chunk of a hot song, started fresh, leaves
    the true state unless notes move across it as a whole: two runs per chunk.
    """
    song = ["song_id"]
    room = F.greatest(F.col("phones") - F.col("count"), F.lit(0)).cast("bigint")
    sized = scan(phrases, song, ["phrase"], [running_sum("__to", F.col("count"))], hot)

    sized = scan(sized, song, ["phrase"], [Scan("__room_after", "sum", room, inclusive=False, reverse=True)], hot)
    # Phrases and gaps become one stream by note position; a gap follows the phrase that holds it.
    at = (F.col("__to") - F.col("count")).alias("at")
    lowest = (F.col("__to") - F.coalesce("__room_after", F.lit(0))).alias("lowest")
    held = sized.select("song_id", at, F.lit(0).alias("kind"), "phrase", F.col("count").alias("notes"), room.alias("room"), lowest)
    marks = gaps.select("song_id", F.col("boundary_index").alias("at"), F.lit(1).alias("kind"))
    rows = held.unionByName(marks, allowMissingColumns=True)

    def place(cur, waiting, g):
        phrase, begin, end, low = cur
        if g in (begin, end):
            return (phrase, "ALREADY_ALIGNED", g, 0)
        if g > end:
            waiting.append(g)
            return None
        if g < low:
            return (phrase, "FAILED", g, low - g)
        cur[2] = g
        return (phrase, "REALIGNED", g, end - g)

    def rule(rows_, s, last):
        cur, waiting = (s["cur"], s["waiting"]) if s else (None, [])
        for r in rows_:
            if r.kind == 1:
                todo = [int(r.at)] if cur else []
            else:
                begin = int(r.at)
                if cur:
                    yield (cur[0], "COUNT", None, cur[2] - cur[1])
                    begin = cur[2]
                arriving = min(int(r.at) - begin, int(r.room))
                cur = [int(r.phrase), begin, begin + int(r.notes) + arriving, int(r.lowest)]
                todo, waiting = waiting, []
            for g in todo:
                done = place(cur, waiting, g)
                if done:
                    yield done
        if last and cur:
            yield (cur[0], "COUNT", None, cur[2] - cur[1])
        return {"cur": cur, "waiting": waiting}

    schema = "phrase long, kind string, boundary_index long, value long"
    return fold(rows, song, ["at", "kind", "phrase"], rule, schema, refine(hot, rows, song))


def realign_recipients(phrases: DataFrame, realigned: DataFrame, hot=None) -> DataFrame:
    """Which phrases take the notes of each realigned gap: ``song_id, boundary_index, phrase, taken``.

    ``realigned`` comes from ``realign_counts``. Notes that left first arrive first, so both
    sides are lined up by running sums of notes and cut at the borders of either; no gap meets
    a phrase that takes nothing from it.
    """
    song = ["song_id"]
    left = realigned.where("kind = 'REALIGNED'").select("song_id", "phrase", "boundary_index", F.col("value").alias("moved"))
    out = left.groupBy("song_id", "phrase").agg(F.sum("moved").alias("__out"))
    final = realigned.where("kind = 'COUNT'").select("song_id", "phrase", F.col("value").alias("__final"))
    took = F.col("__final") - F.col("count") + F.coalesce("__out", F.lit(0))
    taken = phrases.join(final, ["song_id", "phrase"]).join(out, ["song_id", "phrase"], "left").select("song_id", "phrase", took.alias("moved")).where("moved > 0")

    def lined_up(rows: DataFrame, order: list[str]) -> DataFrame:
        return scan(rows, song, order, [running_sum("upto", F.col("moved"))], refine(hot, rows, song))

    borders = lined_up(left, ["boundary_index"]).select("song_id", "upto", F.lit(0).alias("side"), "boundary_index").unionByName(
        lined_up(taken, ["phrase"]).select("song_id", "upto", F.lit(1).alias("side"), "phrase"), allowMissingColumns=True
    )
    # The two borders at one place follow each other; the later one spans nothing.
    met = scan(
        borders, song, ["upto", "side"],
        [previous("__from", F.col("upto")), next_seen("__gap", F.col("boundary_index")), next_seen("__phrase", F.col("phrase"))],
        refine(hot, borders, song),
    )
    here = F.col("upto") - F.coalesce("__from", F.lit(0))
    return met.where(here > 0).select("song_id", F.col("__gap").alias("boundary_index"), F.col("__phrase").alias("phrase"), here.alias("taken"))


# -- labels ---------------------------------------------------------------------------


def filter_labels(labels: Column, expected: Column, silence: Sequence[str]) -> Column:
    """Labels with unexpected pauses removed; an empty label counts as the first silence label."""
    named = F.transform(labels, lambda x: F.when(F.coalesce(x, F.lit("")) == "", F.lit(silence[0])).otherwise(x))

    def step(kept: Column, x: Column) -> Column:
        due = F.coalesce(F.try_element_at(expected, F.size(kept) + 1).isin(*silence), F.lit(False))
        return F.when(x.isin(*silence) & ~due, kept).otherwise(F.concat(kept, F.array(x)))

    return F.aggregate(named, F.array().cast("array<string>"), step)


