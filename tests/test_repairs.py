"""Edit scripts, label alignment and range counts against direct versions on small items."""

import random

import pytest
from pyspark.sql import functions as F

from tessitura.operators import contracts as ct
from tessitura.operators import repairs as rp
from tessitura.operators import windows as wn

ELEMENTS = "item long, element long, kind string, pitch long, dur long"
PHONES = "item long, ph_index long, phone string, unit long, dur long"
ITEM = ["item"]


@pytest.fixture(params=[4_000_000, 40])
def hot(spark, request):
    """The plain route, and the one that cuts every item into chunks."""
    spark.conf.set("spark.tessitura.maxRowsPerTask", str(request.param))
    yield None
    spark.conf.unset("spark.tessitura.maxRowsPerTask")


def plain(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def directly(elements, phones, failed):
    """One item at a time: absorb failed rests in both lists; None for an item with an issue."""
    notes, spoken = [list(e) for e in elements], [list(p) for p in phones]
    rests = [k for k, e in enumerate(notes) if e[1] == "rest"]
    pauses = [k for k, p in enumerate(spoken) if p[0] == "SP"]
    for n, k in enumerate(rests):
        if not failed(elements[k]):
            continue
        left = next((j for j in range(k - 1, -1, -1) if notes[j][1] == "note"), None)
        right = next((j for j in range(k + 1, len(notes)) if notes[j][1] == "note"), None)
        if left is None and right is None:
            return None
        near = right if left is None or (right is not None and abs(60 - notes[right][2]) <= abs(60 - notes[left][2])) else left
        if spoken:
            if n >= len(pauses):
                return None
            step, j = (1 if near > k else -1), pauses[n]
            j += step
            while 0 <= j < len(spoken) and phones[j][0] == "SP":
                j += step
            if not 0 <= j < len(spoken):
                return None
            spoken[j][2] += phones[pauses[n]][2]
            spoken[pauses[n]][0] = None
        notes[near][3] += elements[k][3]
        notes[k][1] = None
    return [e for e in notes if e[1]], [p for p in spoken if p[0]]


def test_absorbed_rests_in_notes_and_phones(spark, hot):
    rnd, elements, phones, want = random.Random(4), [], [], {}
    for item in range(60):
        es, ps = [], []
        for k in range(rnd.randint(1, 9)):
            kind, dur = rnd.choice(["note", "rest"]), rnd.randint(1, 30)
            es.append((k, kind, rnd.randint(55, 65) if kind == "note" else None, dur))
            if item % 5 and not (item % 7 == 0 and kind == "rest"):
                unit = len({p[1] for p in ps}) - (1 if kind == "rest" and ps and rnd.random() < 0.5 else 0)
                ps += [("SP", unit, dur)] if kind == "rest" else [("c", unit, 1), ("v", unit, dur - 1)][: rnd.randint(1, 2)]
        elements += [(item, *e) for e in es]
        phones += [(item, k, *p) for k, p in enumerate(ps)]
        want[item] = directly(es, ps, lambda e: e[3] < 20)
    made = rp.absorb_rests(spark.createDataFrame(elements, ELEMENTS), spark.createDataFrame(phones, PHONES), ITEM, F.lit(60), F.col("dur") < 20)
    notes, spoken, edits, issues = made
    bad = {r["item"] for r in issues.collect()}
    assert bad == {k for k, v in want.items() if v is None} and bad and not bad & {r["item"] for r in edits.collect()}
    for item, pair in want.items():
        got = [tuple(r) for r in notes.where(F.col("item") == item).orderBy("element").select("kind", "pitch", "dur").collect()] if item < 8 else None
        if pair and got is not None:
            assert got == [tuple(e[1:]) for e in pair[0]]
    left = {}
    for r in spoken.orderBy("item", "ph_index").collect():
        left.setdefault(r["item"], []).append((r["phone"], r["unit"], r["dur"]))
        assert r["ph_index"] == len(left[r["item"]])
    for item, pair in want.items():
        if pair:
            units = {u: n + 1 for n, u in enumerate(dict.fromkeys(p[1] for p in pair[1]))}
            assert left.get(item, []) == [(p[0], units[p[1]], p[2]) for p in pair[1]]
    counts = plain(rp.unit_counts(spoken, ITEM))
    assert all(n > 0 for _, _, n in counts) and sum(n for _, _, n in counts) == sum(map(len, left.values()))


def greedy(found, expected, silence):
    """Labels kept by a pointer that moves over the expected ones."""
    kept = []
    for label in found:
        if label in silence:
            if len(kept) < len(expected) and expected[len(kept)] in silence:
                kept.append(label)
            continue
        kept.append(label)
    return kept


def test_alignment_keeps_what_a_pointer_would_keep(spark, hot):
    rnd, found, expected, want = random.Random(9), [], [], {}
    for item in range(120):
        words = [rnd.choice(["a", "b", "sil", "sil"]) for _ in range(rnd.randint(0, 12))]
        due = [w for w in words if w != "sil" or rnd.random() < 0.5]
        if item % 6 == 0 and due:
            due[rnd.randrange(len(due))] = rnd.choice(["z", "sil"])
        found += [(item, k, "" if w == "sil" and k % 2 else w, 10 * k, 10 * k + 10) for k, w in enumerate(words)]
        expected += [(item, k, w) for k, w in enumerate(due)]
        want[item] = greedy(words, due, {"sil"}) == due
    pairs = rp.align_labels(spark.createDataFrame(found, "item long, idx long, label string, start long, end long"), spark.createDataFrame(expected, "item long, pos long, phone string"), ITEM, ["sil"])
    broken = {r["item"] for r in rp.alignment_issues(pairs, ITEM).collect()}
    assert broken == {k for k, fine in want.items() if not fine} and 0 < len(broken) < 60
    assert pairs.where("idx is not null").count() == len(found) and pairs.where("pos is not null").count() == len(expected)


LABELS = [("", 0, 30), ("a", 30, 50), ("i", 50, 90), ("sil", 90, 100)]
# found, expected, end of the item, notes begin with a rest, notes end with one; boundary edits and phones
BORDERS = [
    (LABELS, ["a", "i"], 100, False, False, [("leading", 30, "PHONE_EXTENDED"), ("trailing", 10, "PHONE_EXTENDED")], [("a", 50), ("i", 50)]),
    (LABELS, ["a", "i"], 100, True, True, [("leading", 30, "PAUSE_INSERTED"), ("trailing", 10, "PAUSE_INSERTED")], [("SP", 30), ("a", 20), ("i", 40), ("SP", 10)]),
    (LABELS, ["sil", "a", "i", "sil"], 100, False, False, [], [("sil", 30), ("a", 20), ("i", 40), ("sil", 10)]),
    (LABELS[1:3], ["a", "i"], 90, False, False, [("leading", 30, "BOUNDARY_UNEXPLAINED")], []),
    (LABELS, ["a", "x"], 100, False, False, [("leading", 30, "PHONE_EXTENDED"), ("trailing", 10, "PHONE_EXTENDED")], []),
]


def test_boundary_time(spark):
    found = [(n, k, *x) for n, case in enumerate(BORDERS) for k, x in enumerate(case[0])]
    expected = [(n, k, p) for n, case in enumerate(BORDERS) for k, p in enumerate(case[1])]
    pairs = rp.align_labels(spark.createDataFrame(found, "item long, idx long, label string, start long, end long"), spark.createDataFrame(expected, "item long, pos long, phone string"), ITEM, ["sil"])
    items = spark.createDataFrame([(n, *case[2:5]) for n, case in enumerate(BORDERS)], "item long, item_end long, lead_rest boolean, trail_rest boolean")
    edits = rp.boundary_edits(pairs, items, ITEM, ["sil"])
    assert plain(edits, "item", "side", "gap", "resolution") == sorted(((n, *e) for n, case in enumerate(BORDERS) for e in case[5]), key=str)
    phones = [tuple(r) for r in rp.aligned_phones(pairs, edits, ITEM).orderBy("item", "pos").select("item", "phone", "dur").collect()]
    assert phones == [(n, *p) for n, case in enumerate(BORDERS) for p in case[6]]


def test_range_counts(spark, hot):
    rnd = random.Random(2)
    points = [(k % 3, rnd.randint(0, 50), 1) for k in range(200)]
    ranges = [(k % 3, k, a, a + rnd.randint(0, 20)) for k, a in enumerate(rnd.randint(-5, 50) for _ in range(60))]
    got = rp.range_counts(spark.createDataFrame(ranges, "item long, id long, start long, end long"), spark.createDataFrame(points, "item long, at long, weight long"), ITEM, ["id"])
    assert plain(got) == sorted(((i, k, sum(a <= x < b for j, x, _ in points if j == i)) for i, k, a, b in ranges), key=str)


def test_notes_against_crowded_windows(spark, hot):
    rnd = random.Random(7)
    notes = [("s", k, a, a + rnd.randint(-2, 25)) for k, a in enumerate(rnd.randint(0, 200) for _ in range(150))]
    windows = [("s", f"w{k}", a, a + rnd.randint(0, 30)) for k, a in enumerate(rnd.randint(0, 200) for _ in range(40))]
    for eps in (0, 1):
        got = wn.audit_notes(spark.createDataFrame(notes, "song_id string, note_index long, start_us long, end_us long"), spark.createDataFrame(windows, "song_id string, clip_id string, start_us long, end_us long"), eps)
        want = []
        for _, k, a, b in notes:
            hits = [(c, d) for _, _, c, d in windows if d - c > 2 * eps and b > c + eps and a < d - eps and b > a]
            inside = len(hits) == 1 and a >= hits[0][0] - eps and b <= hits[0][1] + eps
            want.append((k, len(hits), int(inside), "invalid" if b <= a else "contained" if inside else "cut" if hits else "outside"))
        assert plain(got, "note_index", "hits", "inside", "status") == sorted(want, key=str)


def test_run_audit_inputs(spark):
    none = spark.createDataFrame([], "song_id string, name string, start_us long, end_us long, offset string, text string, lang string, ph_seq string, ph_num string, note_seq string, note_dur string, note_slur string, ph_dur string, f0_seq string, f0_timestep string")
    extents = spark.createDataFrame([("s", 10)], "song_id string, extent long")
    sources = spark.createDataFrame([("a", "a"), ("b", "c"), ("d", None), (None, "e")], "sha256 string, current_sha256 string")
    audio = spark.createDataFrame([(44_100, 1, 16), (44_100, 2, 16), (None, 1, 16)], "sample_rate long, channels long, bit_depth long")
    alignments = spark.createDataFrame([("aligned", True), ("aligned", False), ("failed", True), (None, None)], "status string, textgrid boolean")
    checks = ct.run_audit(none, none.select("song_id", "start_us", "end_us"), extents, spark.createDataFrame([], "status string"), [], sources=sources, audio=audio, alignments=alignments)
    got = {r["code"]: r["failures"] for r in checks.collect()}
    assert (got["SOURCE_HASHES"], got["AUDIO_FORMAT"], got["MFA_TEXTGRIDS"], got["LANGUAGE_PROFILE"], got["BUILD_EXISTS"]) == (1, 2, 3, 1, 1)
