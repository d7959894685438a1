"""Literal cases for operators, contracts and jobs."""

import hashlib
import pathlib
import random

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from tessitura.functions import scalar as fn
from tessitura.operators import captions as cp
from tessitura.operators import consensus as cs
from tessitura.operators import contracts as ct
from tessitura.operators import evidence as ev
from tessitura.operators import folds
from tessitura.operators import issues as iss
from tessitura.operators import manifest as mf
from tessitura.operators import mapping as mp
from tessitura.operators import sequences as sq
from tessitura.operators import signal as sg
from tessitura.operators import stats as st
from tessitura.operators import windows as wn
from tessitura.plans import jobs
from tessitura.plans.catalogue import QUERIES
from tessitura.plans.views import Tables

NOTES = "song_id string, note_index long, start_us long, end_us long"
SPANS = "song_id string, start_us long, end_us long"
WINS = "song_id string, clip_id string, start_us long, end_us long"
SEC = 1_000_000


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def one(spark, **cols):
    return tuple(spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first())


# -- functions ----------------------------------------------------------------------


def test_scalars(spark):
    lit = F.lit
    assert one(spark, a=fn.note_to_midi(lit("C4")), b=fn.note_to_midi(lit("A#3+12.5")), c=fn.note_to_midi(lit("rest")), d=fn.note_to_midi(lit("Bb-1"))) == (60, 58, None, 10)
    assert one(spark, a=fn.clock_seconds(lit("1:02:03,500")), b=fn.truthy(lit(" Yes ")), c=fn.truthy(lit(None).cast("string"))) == (3723.5, True, False)
    assert one(spark, a=fn.safe_double(lit("x"), 7.0), b=fn.safe_double(lit("Infinity")), c=fn.safe_double(lit("2.5"))) == (7.0, None, 2.5)
    assert one(spark, a=fn.clip_round(lit(0.6125), 0.5, 0.62), b=fn.octave_distance(lit(12.1)), c=fn.to_sample(lit(2.5), 1)) == (0.612, pytest.approx(0.1), 2)
    assert one(spark, a=fn.canonical_phones(F.array(lit("i:"), lit(" "), lit("sil"), lit("k"))))[0] == ["i", "SP", "k"]
    assert one(spark, a=fn.variant_hash(lit("k"), F.array(lit("a"), lit("b"))))[0] == hashlib.sha256(b"k\ta b").hexdigest()[:16]
    assert one(spark, a=fn.short_sha1("ds-", lit("a"), lit(None).cast("string"), lit(3)))[0] == "ds-" + hashlib.sha1(b"a||3").hexdigest()[:12]
    assert one(spark, a=fn.recording_group(lit("x_32k_mono.wav_001.wav")), b=fn.recording_group(lit("d/y.z.wav")), c=fn.wav_stem(lit("d/y.wav"))) == ("x", "y.z", "y")
    assert tuple(one(spark, a=fn.checkpoint_numbers(lit("m_e12_s340.pth")))[0]) == (12, 340)
    assert one(spark, a=fn.safe_path(lit("a/b.wav")), b=fn.safe_path(lit("a/../b")), c=fn.safe_path(lit("C:\\x")), d=fn.safe_path(lit("")))[0:4] == (True, False, False, False)
    assert one(spark, a=fn.canonical_json("id"))[0] == '{"id":0}'


# -- windows ------------------------------------------------------------------------


def test_window_audit_fixture(spark):
    w = spark.createDataFrame([("s", "a", 0, 1000), ("s", "b", 1000, 2000)], WINS)
    n = spark.createDataFrame([("s", 0, 800, 1200), ("s", 1, 1300, 1600), ("s", 2, 5000, 5100), ("s", 3, 10, 10)], NOTES)
    assert rows(wn.audit_notes(n, w), "note_index", "status") == [(0, "cut"), (1, "contained"), (2, "outside"), (3, "invalid")]
    got = wn.song_audit(n, w).first().asDict()
    assert (got["cut"], got["contained"], got["empty_windows"], got["status"]) == (1, 1, 0, "REVIEW_REQUIRED")


def test_rest_insertion_fixture(spark):
    w = spark.createDataFrame([("s", "w", 0, 3 * SEC)], WINS)
    n = spark.createDataFrame([("s", 0, SEC // 2, SEC), ("s", 1, 3 * SEC // 2, 2 * SEC)], NOTES).withColumn("pitch", F.lit(60))
    none = spark.createDataFrame([], SPANS)
    elements, issues, pauses, coverage = jobs.segment_plan(w, none, n, 2 * SEC, 15 * SEC)
    assert [r["kind"] for r in elements.orderBy("element").collect()] == ["rest", "note", "rest", "note", "rest"]
    assert elements.agg(F.sum(F.col("end_us") - F.col("start_us"))).first()[0] == 3 * SEC
    assert issues.count() == 0 and pauses.count() == 0
    assert rows(coverage, "state") == [("EQUAL",)]


def test_short_residual_fixture(spark):
    w = spark.createDataFrame([("s", "w", 0, 3 * SEC)], WINS)
    cut = spark.createDataFrame([("s", SEC, 1_800_000)], SPANS)
    n = spark.createDataFrame([("s", 0, 200_000, 600_000), ("s", 1, 2_200_000, 2_600_000)], NOTES).withColumn("pitch", F.lit(60))
    elements, issues, pauses, coverage = jobs.segment_plan(w, cut, n, 2 * SEC, 15 * SEC)
    assert rows(pauses, "start_us", "end_us") == [(SEC, 1_800_000)]
    assert issues.count() == 0 and rows(coverage, "expected_start", "expected_end", "state") == [(0, 3 * SEC, "EQUAL")]


def test_prune_budget_fixture(spark):
    w = spark.createDataFrame([("s", "w", 0, 60_000), ("t", "w", 0, 60_000)], WINS)
    x = spark.createDataFrame([("s", 0, 2_000), ("s", 1_500, 3_000), ("t", 0, 3_100)], SPANS)
    assert rows(wn.prune_budget(x, w, 5), "song_id", "pruned_us", "status") == [("s", 3_000, "BLOCKED_PRUNE_BUDGET"), ("t", 3_100, "BLOCKED_PRUNE_BUDGET")]
    assert {r["status"] for r in wn.prune_budget(x, w, 6).collect()} == {"WITHIN_BUDGET"}
    # A song that is all windows pays for one that has cuts only.
    only = spark.createDataFrame([("u", 0, 2_000)], SPANS)
    got = wn.prune_budget(only, w, 5).orderBy("song_id").collect()
    assert [(r["song_id"], r["total_us"], r["pruned_us"], r["status"]) for r in got] == [("s", 60_000, 0, "WITHIN_BUDGET"), ("t", 60_000, 0, "WITHIN_BUDGET"), ("u", 0, 2_000, "WITHIN_BUDGET")]
    assert {r["status"] for r in wn.prune_budget(only, w, 5, carried_us=4_001).collect()} == {"BLOCKED_PRUNE_BUDGET"}


# -- evidence -----------------------------------------------------------------------


def test_gap_classes_fixture(spark):
    df = spark.createDataFrame([(-33.0, -15.0, 0.04, 0.04), (-18.0, -15.0, 0.42, 0.30), (-32.0, -18.0, 0.08, 0.08)], "g double, n double, v double, r double")
    got = [r[0] for r in df.select(ev.classify_gap(F.col("g"), F.col("n"), F.col("v"), F.col("r"))).collect()]
    assert got == ["REST_CANDIDATE", "VOCAL_EVIDENCE", "EVIDENCE_INSUFFICIENT"]


SUM = "struct<voiced_ratio:double,longest_voiced_sec:double,max_hole_sec:double,median_midi:double>"


def test_dual_gate_fixture(spark):
    df = spark.createDataFrame([((0.8, 0.12, 0.02, 69.0), (0.75, 0.10, 0.03, 69.3)), ((0.8, 0.06, 0.02, 69.0), (0.8, 0.09, 0.02, 70.0))], f"a {SUM}, b {SUM}")
    got = [r[0] for r in df.select(ev.dual_gate(F.col("a"), F.col("b"), F.lit(69.0))).collect()]
    assert got[0] == []
    assert got[1] == ["backend_pitch_disagreement", "second_note_pitch_mismatch", "voiced_island"]


def test_pitch_gate_fixture(spark):
    data = [("octave", v) for v in [0.1] * 90 + [12.1] * 10] + [("bad", v) for v in [0.1] * 80 + [2.0] * 20] + [("few", v) for v in [0.1] * 95 + [1.3] * 5]
    got = {r["k"]: r for r in st.pitch_delta_summary(spark.createDataFrame(data, "k string, d double"), ["k"], F.col("d")).collect()}
    assert {k: r["pitch_gate"] for k, r in got.items()} == {"octave": "robust_crosscheck", "bad": "blocked", "few": "raw"}
    assert got["octave"]["octave_frames"] == 10 and got["octave"]["adjusted_p95"] <= 0.1 + 1e-9 and got["few"]["over_1"] == 5


def test_pitch_mode_fixture(spark):
    data = [("s", i, v) for i, v in enumerate([440.0, 441.0, 439.0, 440.0, 440.0])] + [("c", i, v) for i, v in enumerate([440.0, 440.0, 659.25, 659.25])]
    got = {r["k"]: r for r in st.pitch_mode(spark.createDataFrame(data, "k string, i int, f double"), ["k"], ["i"], fn.hz_to_midi(F.col("f"))).collect()}
    assert (got["s"]["f0_mode_midi"], got["s"]["f0_mode_ratio"]) == (69, 1.0) and got["s"]["f0_span_semitone"] <= 1.0
    assert got["c"]["f0_mode_midi"] == 69 and got["c"]["f0_span_semitone"] > 5.0


def test_percentiles_match_numpy(spark, tiny_tasks):
    values = [float(x) for x in np.random.default_rng(3).integers(0, 40, 90)]
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    got = st.percentiles(df, ["k"], F.col("v"), {"a": ("linear", 0.1), "b": ("linear", 0.75), "c": ("nearest", 0.95), "d": ("upper", 0.5)}).first()
    ordered = sorted(values)
    assert (got["a"], got["b"]) == (pytest.approx(np.percentile(values, 10)), pytest.approx(np.percentile(values, 75)))
    assert (got["c"], got["d"]) == (ordered[int(np.ceil(90 * 0.95)) - 1], ordered[45])
    whole = st.percentiles(df, [], F.col("v"), {"m": ("linear", 0.5)}).first()
    assert whole["m"] == pytest.approx(np.median(values))


def test_run_lengths(spark, tiny_tasks):
    flags = [bool(int(c)) for c in "0011101000110111100"]
    got = st.run_lengths(spark.createDataFrame([("k", i, f) for i, f in enumerate(flags)] + [("n", 0, False)], "k string, i int, f boolean"), ["k"], ["i"], F.col("f"))
    assert rows(got, "k", "rows", "longest_run", "max_hole", "true_rows") == [("k", 19, 4, 3, 10), ("n", 1, 0, 0, 0)]


def test_gap_repairs_fixture(spark):
    n = spark.createDataFrame([("s", 0, 0, 400, 60), ("s", 1, 900, 1200, 60), ("s", 2, 1500, 1800, 62)], NOTES + ", pitch long")
    schema = "song_id string, boundary_index long, status string, gap_len long, voiced_ratio double, mode_ratio double, span_semitone double, pitch_match boolean, matches_left boolean, matches_right boolean, gap_dbfs double, relative_db double"
    e = spark.createDataFrame([("s", 1, "VOCAL_EVIDENCE", 500, 0.5, 0.9, 0.5, True, True, True, -20.0, -5.0), ("s", 2, "VOCAL_EVIDENCE", 300, 0.3, 0.95, 0.5, False, True, False, -20.0, -5.0)], schema)
    repairs, fixed = jobs.gap_repair(n, e, 1000)
    assert rows(repairs, "note_index", "new_end", "resolution") == [(0, 900, "EXTEND_LEFT_SAME_PITCH_NOTE"), (1, 1500, "EXTEND_LEFT_F0_MATCHED_NOTE")]
    assert rows(fixed, "note_index", "end_us") == [(0, 900), (1, 1500), (2, 1800)]


def test_autocorrelation_pitch(spark):
    t = np.arange(1764) / 44100
    tone = [float(x) for x in 8000 * np.sin(2 * np.pi * 220 * t)]
    df = spark.createDataFrame([(tone,), ([0.0] * 1764,)], "samples array<float>")
    got = [r[0] for r in df.select(sg.autocorrelation_pitch(44_100)("samples")).collect()]
    assert got[0] == pytest.approx(220, rel=0.01) and got[1] is None


# -- issues and pronunciation ---------------------------------------------------------


def test_roots_fixture(spark):
    df = spark.createDataFrame(
        [("root-row", "song-001", "MIDI_GAP_AUDIO_CONFLICT", 7, ""), ("dependent-row", "song-001", "INTRA_PHRASE_MIDI_GAP", 7, "p003")],
        "issue_id string, song_id string, type string, boundary_index long, segment_id string",
    )
    assert rows(iss.roots(df), "root_issue_id", "root_original_issue_id", "members") == [("song-001:boundary:7", "root-row", 2)]
    assert rows(iss.membership(df), "issue_id", "is_root") == [("dependent-row", False), ("root-row", True)]


def test_pronunciation_root_uses_hash_pair(spark):
    df = spark.createDataFrame([("i1", "s", "PRONUNCIATION_CROSSCHECK_MISMATCH", "p1", "primary=ab12; secondary=cd34"), ("i2", "s", "PRONUNCIATION_CROSSCHECK_MISMATCH", "p2", "primary=ab12; secondary=cd34")],
                               "issue_id string, song_id string, type string, segment_id string, proposed_value string").withColumn("boundary_index", F.lit(None).cast("long"))
    assert rows(iss.roots(df), "root_issue_id", "members") == [("s:pron:ab12:cd34", 2)]


def test_dedup_upgrades_status(spark):
    df = spark.createDataFrame([("a", "pending", 1), ("a", "Waived", 2), ("a", "accepted", 3), ("b", "accepted", 4), ("b", "pending", 5)], "issue_id string, status string, position long")
    assert rows(iss.deduplicate(df, "position", ["position"]).select("issue_id", "status", "copies"), "issue_id", "status", "copies") == [("a", "Waived", 3), ("b", "accepted", 2)]


def test_vote_fixture(spark):
    data = [("p", "a", "a i a"), ("p", "b", "a i a"), ("p", "c", "a i: a"), ("q", "a", "a"), ("q", "b", "i"), ("q", "c", "u")]
    df = spark.createDataFrame(data, "phrase string, backend string, line string").withColumn("line", F.array_join(fn.canonical_phones(fn.tokens(F.col("line"))), " "))
    assert rows(cs.vote(df, ["phrase"], "line", "backend"), "phrase", "quorum", "status", "phones") == [("p", 3, "LOCKED", "a i a"), ("q", 1, "UNRESOLVED", "")]


def test_token_mapping_context(spark):
    allowed = ["a", "i", "k", "c", "m", "ŋ", "ɴ", "aː", "SP"]
    df = spark.createDataFrame([(0, ["k", "i", "N", "pau", "k", "a", "a", "a"]), (1, ["N", "m"]), (2, ["N"])], "id long, t array<string>")
    got = [r["m"] for r in sorted(cs.map_tokens(df, "t", allowed, True).collect())]
    assert got[0]["phones"] == ["c", "i", "ŋ", "SP", "k", "aː", "a"]
    assert got[0]["review_flags"] == ["contextual_mapping", "nasal_context", "pause", "long_vowel"]
    assert got[1]["phones"] == ["m", "m"] and got[2]["phones"] == ["ɴ"]


def test_canonical_vote(spark):
    said = [("p", "a", ["i:", " ", "sil"]), ("p", "b", ["i", "SP"]), ("p", "c", ["a"]), ("q", "a", ["a"]), ("q", "b", ["i"]), ("q", "c", None), ("r", "a", [" "]), ("r", "b", []), (None, "a", ["o:"]), (None, "b", ["o"])]
    df = spark.createDataFrame(said, "phrase string, backend string, phones array<string>")
    got = {r["phrase"]: (r["quorum"], r["status"], r["phones"]) for r in cs.vote_phones(df, ["phrase"], "phones", "backend").collect()}
    assert got == {"p": (2, "LOCKED", "i SP"), "q": (1, "UNRESOLVED", ""), "r": (0, "UNRESOLVED", ""), None: (2, "LOCKED", "o")}


def test_index_issues_and_lone_phrases(spark):
    phrases = spark.createDataFrame([("s", 0), ("s", 1), ("s", 2), ("t", 0)], "song_id string, phrase long")
    claims = spark.createDataFrame([("s", 0, 0), ("s", 0, 1), ("s", 1, -1), ("s", 1, 2), ("s", 1, 2), ("t", 0, 0)], "song_id string, phrase long, note_index long")
    notes = spark.createDataFrame([("s", 0, 0, 10), ("s", 1, 10, 30)], "song_id string, note_index long, start_us long, end_us long")
    assert rows(sq.index_issues(phrases, claims, notes), "type", "song_id", "phrase", "note_index") == [
        ("TIMING_SOURCE_NOTE_INDEX_INVALID", "s", 1, -1), ("TIMING_SOURCE_NOTE_INDEX_INVALID", "s", 1, 2), ("TIMING_SOURCE_NOTE_INDEX_INVALID", "t", 0, 0), ("TIMING_SOURCE_NOTE_INDEX_MISSING", "s", 2, None)
    ]
    sung = notes.withColumn("phrase", F.lit(0).cast("bigint"))
    totals = spark.createDataFrame([("s", 0, 30), ("s", 2, 7)], "song_id string, phrase long, ph_total long")
    more = sung.unionByName(spark.createDataFrame([("s", 5, 40, 50, 3)], "song_id string, note_index long, start_us long, end_us long, phrase long"))
    got = sq.phrase_timing(more, totals, ["song_id", "phrase"])
    assert rows(got, "phrase", "note_count", "note_total", "ph_total", "score_span", "mismatch") == [(0, 2, 30, 30, 30, False), (2, 0, 0, 7, 0, True), (3, 1, 10, 0, 10, True)]


def test_boundary_jumps(spark):
    x = spark.createDataFrame([("s", i, v) for i, v in enumerate([0.0, 1.0, 0.25, 0.25, None])], "song string, n long, x double")
    b = spark.createDataFrame([("s", k) for k in (0, 1, 2, 2, 3, 4, 5, 9)] + [("t", 1)], "song string, at long")
    assert rows(sg.boundary_jumps(b, x, ["song"], "at", "n", "x"), "song", "at", "jump") == [
        ("s", 0, 0.0), ("s", 1, 1.0), ("s", 2, 0.75), ("s", 2, 0.75), ("s", 3, 0.0), ("s", 4, 0.0), ("s", 5, 0.0), ("s", 9, 0.0), ("t", 1, 0.0)
    ]


def mapped_tokens(tokens, allowed):
    """Phones and joined pairs, token after token."""
    skip, out = (*cs.MARK_TOKENS, *cs.PAUSE_TOKENS), []
    for i, t in enumerate(tokens):
        nxt = next((x for x in tokens[i + 1 :] if x is not None and x not in skip), "")
        if t is None or t in cs.MARK_TOKENS or t in cs.PUNCTUATION or not t.strip():
            continue
        if t in cs.PAUSE_TOKENS:
            p = "SP"
        elif t == "N":
            p = cs.NASAL_NEXT.get(nxt, "ɴ")
        elif nxt == "i" and t in cs.BEFORE_I:
            p = cs.BEFORE_I[t]
        else:
            p = cs.PLAIN_TOKENS.get(t, t)
        if out and out[-1] == p and cs.LONG_VOWELS.get(p) in allowed:
            out[-1] = cs.LONG_VOWELS[p]
        else:
            out.append(p)
    return out


def test_token_mapping_random(spark, tiny_tasks):
    rng = random.Random(11)
    allowed = ["a", "aː", "i", "iː", "ɨ", "k", "c", "SP"]
    texts = [[rng.choice(["a", "a", "a", "i", "i", "u", "k", "n", "N", "pau", "[", "!", "(", "ky", " ", None]) for _ in range(rng.randrange(0, 40))] for _ in range(30)]
    texts += [["a"] * 3001, [], texts[0], texts[0], ["(", " "], None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t array<string>")
    got = {r["id"]: r["m"] for r in cs.map_tokens(df, "t", allowed, True).collect()}
    assert len(got) == len(texts) and got[len(texts) - 1] is None
    for i, t in enumerate(texts[:-1]):
        want = mapped_tokens(t, allowed)
        assert got[i]["phones"] == want, t
        assert got[i]["unknown"] == list(dict.fromkeys(p for p in want if p not in allowed))
        assert ("long_vowel" in got[i]["review_flags"]) == any(p in ("aː", "iː") for p in want)


def test_label_filter(spark):
    df = spark.createDataFrame([(["", "k", "a", "", "i"], ["k", "a", "i"]), (["k", "", "a"], ["k", "sil", "a"])], "l array<string>, e array<string>")
    assert [r[0] for r in df.select(folds.filter_labels(F.col("l"), F.col("e"), ["sil"])).collect()] == [["k", "a", "i"], ["k", "sil", "a"]]


# -- sequences ------------------------------------------------------------------------


ITEM = dict(name="x", offset="0", text="t", lang="ja", ph_seq="a i", ph_num="2", note_seq="C4 D4", note_dur="0.5 0.5", note_slur="0 1", ph_dur="0.5 0.5", f0_seq="220 220", f0_timestep="0.01")


def issue_types(spark, **change):
    return {r["type"] for r in sq.item_issues(spark.createDataFrame([{**ITEM, **change}]), "name", allowed=["a", "i", "SP"]).collect()}


def test_item_contract(spark):
    assert issue_types(spark) == set()
    assert issue_types(spark, ph_num="1") == {"PH_NUM_MISMATCH"}
    assert issue_types(spark, note_slur="1 1") == {"NOTE_SLUR_FIRST_INVALID", "NOTE_SLUR_WORD_MISMATCH"}
    assert issue_types(spark, ph_dur="0.5 0.6") == {"DURATION_TOTAL_MISMATCH"}
    assert issue_types(spark, ph_seq="a x", f0_timestep="0") == {"UNKNOWN_PHONEME", "F0_TIMESTEP_INVALID"}
    assert issue_types(spark, note_dur="0.5", note_slur="0 2") == {"NOTE_SEQUENCE_MISMATCH", "UNKNOWN_NOTE_SLUR", "DURATION_TOTAL_MISMATCH"}


def test_reconcile_length(spark):
    df = spark.createDataFrame([([0.5, 0.5, 0.0], 1.0001), ([0.5, 0.5], 1.1)], "d array<double>, t double")
    got = [r[0] for r in df.select(sq.reconcile_length(F.col("d"), F.col("t"), 8 / 44_100)).collect()]
    assert got[0] == pytest.approx([0.5, 0.5001, 0.0]) and got[1] == [0.5, 0.5]


def test_span_fill_fixture(spark):
    spans = spark.createDataFrame([("s", 0, 0, 22_050), ("s", 1, 22_050, 44_100)], "song_id string, span_index long, span_start long, span_end long")
    n = spark.createDataFrame([("s", 0, 0, 44_100)], NOTES)
    filled, audit = jobs.timing_repair(n, spans, 10_000, 44)
    assert rows(filled, "span_index", "note_index", "start", "end") == [(0, 0, 0, 22_050), (1, 0, 22_050, 44_100)]
    assert rows(audit, "status") == [("PASS",), ("PASS",)]


def test_span_bridge_fixture(spark):
    schema = "song_id string, entry_index long, start long, end long, score_start long, score_end long, lead_status string, trail_status string, bridge_status string"
    df = spark.createDataFrame([("s", 0, 0, 39_690, 0, 39_690, None, None, "VOCAL_EVIDENCE"), ("s", 1, 44_100, 66_150, 44_100, 66_150, None, None, None)], schema)
    got = rows(sq.expand_spans(df), "entry_index", "new_start", "new_end", "scale")
    assert got == [(0, 0, 44_100, round(44_100 / 39_690, 6)), (1, 44_100, 66_150, 1.0)]


def test_allocation_fixture(spark):
    df = spark.createDataFrame([("s", i, w) for i, w in enumerate([24, 43, 64])], "k string, i long, w long")
    got = [r[0] for r in mf.allocate(df, spark.createDataFrame([("s", 7)], "k string, total long"), ["k"], "i", "w").orderBy("i").select("allocated").collect()]
    assert sum(got) == 7 and min(got) >= 1 and got[2] >= got[1]
    assert mf.allocate(df, spark.createDataFrame([("s", 2)], "k string, total long"), ["k"], "i", "w").where("allocated is not null").count() == 0


def test_mapping_fixture(spark):
    phrases = spark.createDataFrame([("s", 0, ["a", "i"]), ("s", 1, ["c", "i"])], "song_id string, phrase long, phones array<string>")
    n = spark.createDataFrame([("s", 0, 0, 400_000), ("s", 1, 400_000, 800_000), ("s", 2, SEC, 1_400_000)], NOTES)
    counts = mp.note_counts(phrases, n)
    assigned = mp.assign_notes(counts, n)
    assert assigned.count() == 3 and rows(assigned.where("phrase_index = 0"), "note_slur") == [(0,), (0,)]
    assert assigned.agg(F.sum("phone_count")).first()[0] == 4
    assert rows(mp.mapping_contract(assigned, n), "errors") == [(None,)]
    skeleton = mp.score_skeleton(assigned.withColumn("pitch", F.lit(60)), phrases)
    assert rows(skeleton, "phrase", "ph_seq", "ph_num")[0] == (0, "a i", "2")


def test_caption_schedule_modes(spark):
    base = {label: 0.05 for label in cp.LABELS}
    data = [dict(base, song="t", start=0.0, end=1.0, w=1.0, acoustic_intensity=0.9, sadness=0.9, fear=0.9), dict(base, song="b", start=0.0, end=1.0, w=1.0, acoustic_intensity=0.6, joy=0.6, anticipation=0.3), dict(base, song="r", start=0.0, end=1.0, w=1.0, acoustic_intensity=0.1, sadness=0.4)]
    got = {r["song"]: r for r in cp.schedule(spark.createDataFrame(data), ["song"], "start", "end", "w").collect()}
    assert {k: r["emotion_mode"] for k, r in got.items()} == {"t": "tension_peak", "b": "build", "r": "reflective"}
    assert got["t"]["semantic_top"] == "sadness,fear,joy" and 0.54 <= got["t"]["index_rate"] <= 0.62


# -- contracts and jobs ---------------------------------------------------------------


def speech_row(line, **change):
    base = {c: "v" for c in ct.SPEECH_FIELDS} | dict(line=line, id=f"i{line}", audio_relpath=f"a/{line}.wav", sha256=f"h{line}", language="JA", type="speech", status="accepted", split="train", reject_reason="", recording_group=f"g{line}")
    return base | change


def speech_codes(spark, *data):
    wavs = spark.createDataFrame([(r["audio_relpath"], 32_000, 1, 16) for r in data], "audio_relpath string, sample_rate long, channels long, bit_depth long")
    schema = ", ".join(["line long", *[f"{c} string" for c in ct.SPEECH_FIELDS]])
    df = spark.createDataFrame([tuple(r[c] for c in ("line", *ct.SPEECH_FIELDS)) for r in data], schema)
    return {r["code"] for r in ct.speech_manifest(df, wavs).collect()}


def test_speech_manifest(spark):
    assert speech_codes(spark, speech_row(1), speech_row(2)) == set()
    assert speech_codes(spark, speech_row(1, recording_group="g"), speech_row(2, recording_group="g", split="validation")) == {"recording_group_leakage"}
    assert speech_codes(spark, speech_row(1, status="reject"), speech_row(2, text="a|b", sha256="h1")) == {"reject_reason", "reject_in_training", "text_contains_pipe", "duplicate_sha256"}
    assert speech_codes(spark, speech_row(1, language="EN", split="x", audio_relpath="/abs.wav")) == {"text_language", "invalid_values", "invalid_audio_path"}


def package(spark, **change):
    wavs = spark.createDataFrame([("s1", 44_100, 1, 16, 44_100), ("s2", 44_100, 1, 16, 44_100)], "name string, sample_rate long, channels long, bit_depth long, frames long")
    text = spark.createDataFrame([(n, "a i", change.get("ph_dur", "0.5 0.5"), "2", "C4", "1.0") for n in ("s1", "s2")], "name string, ph_seq string, ph_dur string, ph_num string, note_seq string, note_dur string")
    man = spark.createDataFrame([("s1", "training", "accepted", 1.0), ("s2", "training", change.get("review", "accepted"), 1.0), (None, "exclude", None, None)], "name string, record_type string, review_status string, duration_sec double")
    entries = spark.createDataFrame([(lab, s, e) for lab in ("development", "final") for s, e in (("train", "s1"), ("validation", change.get("prefix", "s2")))], "label string, split string, entry string")
    splits = ct.resolve_split_entries(entries, wavs.select("name"))
    members = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    sums = spark.createDataFrame([("a", "1"), ("b", change.get("sum", "2"))], "path string, sha256 string")
    flags = spark.createDataFrame([("passed", "true"), ("status", change.get("qa", "PASS"))], "key string, value string")
    return {r["code"] for r in ct.training_package(wavs, text, man, splits, members, sums, flags).where("not passed").collect()}


def test_training_package(spark):
    assert package(spark) == set()
    assert package(spark, ph_dur="0.5 0.6") == {"TRAINING_TRANSCRIPTIONS_CONTRACT"}
    assert package(spark, review="pending", sum="9") == {"TRAINING_MANIFEST", "TRAINING_UPLOAD_SHA256SUMS"}
    assert package(spark, prefix="s", qa="BLOCKED") == {"TRAINING_SPLIT_DEVELOPMENT", "TRAINING_SPLIT_FINAL", "TRAINING_QA_FINAL"}
    assert package(spark, prefix="zz") == {"TRAINING_SPLIT_DEVELOPMENT", "TRAINING_SPLIT_FINAL", "TRAINING_SPLIT_DEVELOPMENT_GROUPS", "TRAINING_SPLIT_FINAL_GROUPS"}


@pytest.mark.parametrize("name, lists", [("training_package", 1), ("final_dataset", 2)])
def test_package_checks_read_the_sequences_once(spark, name, lists):
    """no list of an item is built again for each check, and no text of sequences meets a join."""
    plan = QUERIES[name].build(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == lists and "sequence(1, length(name" not in plan


def test_split_entries_by_prefix(spark):
    names = spark.createDataFrame([("a1",), ("a2",), ("a",), ("b",), ("",)], "name string")
    entries = spark.createDataFrame([("x", "t", "a"), ("x", "v", "a1"), ("y", "t", "b"), ("y", "v", "none"), ("z", "t", "c")], "label string, split string, entry string")
    long = spark.createDataFrame([("ab1",), ("ab2",), ("c3",)], "name string")
    assert rows(ct.resolve_split_entries(entries, names.unionByName(long)), "label", "split", "name") == [("x", "t", "a"), ("x", "v", "a1"), ("y", "t", "b"), ("z", "t", "c3")]


def test_batch_repair_on_odd_rows(spark, tmp_path):
    """labels twice or without quality count as the SQL counts them."""
    for f in pathlib.Path("/root/testdata/sf0.001").glob("*.parquet"):
        if f.name != "labels.parquet":
            (tmp_path / f.name).symlink_to(f)
    spark.createDataFrame([(1, 0, 0), (1, 0, 1), (2, None, 0), (3, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "x"))
    (tmp_path / "labels.parquet").symlink_to(next((tmp_path / "x").glob("part-*.parquet")))
    assert not differences(QUERIES["batch_repair_checks"], Tables(spark, str(tmp_path)), connect(str(tmp_path)))


def test_budget_of_a_large_set(spark):
    """a hundred times the cut time is more than a bigint holds."""
    whole = spark.createDataFrame([(2 * 10**17, 10**18), (10**16, 10**18)], "set_pruned_us long, set_total_us long")
    assert rows(wn.with_budget(whole, 5), "set_pruned_us", "status") == [(10**16, "WITHIN_BUDGET"), (2 * 10**17, "BLOCKED_PRUNE_BUDGET")]


def test_singing_manifest(spark):
    clips = spark.createDataFrame([("c1", "x/1.wav", "h1", "s1", "train"), ("c1", "x/2.wav", "bad", "s1", "validation"), ("c3", "../3.wav", "h3", "s2", "train")], "clip_id string, audio_relpath string, audio_sha256 string, song_id string, split string")
    files = spark.createDataFrame([("x/1.wav", 10, "h1", 40_000, 1, 16, 5_000, 0.8), ("x/2.wav", 10, "h2", 40_000, 1, 16, 2_000, 1.0)], "audio_relpath string, bytes long, sha256 string, sample_rate long, channels long, bit_depth long, duration_ms long, peak double")
    need = spark.createDataFrame([("s1",), ("s9",)], "song_id string")
    failed = {r["code"] for r in ct.singing_manifest(clips, files, need, 0, 10_000).where("not passed").collect()}
    assert failed == {"DUPLICATE_CLIP_ID", "INVALID_AUDIO_PATH", "INVALID_CLIP_DURATION", "CLIPPING", "PEAK_NOT_SCALED_TO_MINUS_ONE_DBFS", "AUDIO_HASH_MISMATCH", "SONG_SPLIT_LEAK", "MISSING_REQUIRED_SONG", "SONG_OVERREPRESENTED"}


def run_checks(spark, **change):
    data = [{**ITEM, "song_id": "s", "start_us": 0, "end_us": 44_100, **change}]
    items = spark.createDataFrame(data)
    cuts = spark.createDataFrame([("s", 44_100, 88_200)], SPANS)
    ext = spark.createDataFrame([("s", change.get("extent", 88_200))], "song_id string, extent long")
    reviews = spark.createDataFrame([(change.get("review", "accepted"),)], "status string")
    checks = ct.run_audit(items.drop("extent", "review"), cuts, ext, reviews, ["a", "i", "SP"])
    return {r["code"] for r in checks.where("not passed").collect()}, ct.run_status(checks).first()["status"]


def test_run_audit(spark):
    f0 = " ".join(["220"] * 100)
    assert run_checks(spark, f0_seq=f0) == (set(), "ACOUSTIC_READY")
    assert run_checks(spark, f0_seq=f0, ph_seq="a SP") == ({"VOICED_AS_SP_AP"}, "BLOCKED")
    assert run_checks(spark, f0_seq=f0, extent=100_000, review="pending") == ({"TIMELINE_COVERAGE", "REVIEW_GATE"}, "BLOCKED")
    assert run_checks(spark, f0_seq="220") == ({"F0_FRAME_MISMATCH"}, "BLOCKED")


def test_candidate_and_inventory_contracts(spark):
    good = hashlib.sha256(b"k\ta").hexdigest()[:16]
    df = spark.createDataFrame([("p1", "k", ["a"], ["a"], good, False), ("p2", "k", ["q"], [], "x", True)], "phrase_id string, key string, phones array<string>, raw_tokens array<string>, dictionary_variant string, latin_text boolean")
    assert rows(ct.candidate_entries(df, ["a"]), "phrase_id", "type") == [("p2", t) for t in ("CANDIDATE_ENTRY_INCOMPLETE", "CANDIDATE_UNKNOWN_PHONEME", "CANDIDATE_VARIANT_HASH_MISMATCH", "LATIN_READING_REQUIRES_REVIEW")]
    inv = ct.phone_inventory(spark.createDataFrame([("a",), ("a",), ("<PAD>",)], "phone string"), 2)
    assert rows(inv.where("not passed"), "code") == [("PHONE_COUNT",), ("PHONE_PADDING",), ("PHONE_UNIQUE",)]


def test_speech_import(spark):
    named = spark.createDataFrame([(i, f"g_32k_mono.wav_{i}.wav", "はい") for i in range(8)] + [(9, "none.wav", "x")], "line long, audio_name string, text string")
    wavs = spark.createDataFrame([(f"g_32k_mono.wav_{i}.wav", 32_000, 1, 16, 32_000 * (i + 1), f"h{i}") for i in range(8)], "audio_name string, sample_rate long, channels long, bit_depth long, frames long, sha256 string")
    got, errors = jobs.speech_import(named, wavs, 3, 2)
    assert [r["split"] for r in got.orderBy("id").collect()] == ["smoke_train"] * 3 + ["smoke_benchmark"] * 2 + ["train"] * 3
    assert rows(got.limit(1), "recording_group") == [("g",)] and rows(errors, "audio_name", "reason") == [("none.wav", "AUDIO_MISSING_OR_UNREADABLE")]


def test_review_queue_job(spark):
    report = spark.createDataFrame([("s1", "AUTO_NOTE_MAPPING_REVIEW_REQUIRED", "m", 1), ("s2", "AUTO_NOTE_MAPPING_REVIEW_REQUIRED", "m", 2), ("s1", "X_FAILED", "m", 3), ("s1", "X_FAILED", "m", 4)], "song_id string, type string, message string, position long")
    contracts = spark.createDataFrame([("s1", None), ("s2", "NOTE_TIMING_INVALID")], "song_id string, errors string")
    cross = spark.createDataFrame([("s1", "p1", "ab", "cd", 5)], "song_id string, phrase_id string, primary_variant string, secondary_variant string, position long")
    queue = jobs.review_queue([report], contracts, cross)
    assert rows(queue, "song_id", "type", "copies") == [("s1", "PRONUNCIATION_CROSSCHECK_MISMATCH", 1), ("s1", "X_FAILED", 2), ("s2", "AUTO_NOTE_MAPPING_REVIEW_REQUIRED", 1)]
    assert iss.pending_summary(queue).first()["status"] == "BLOCKED"


def test_freeze_job(spark):
    w = spark.createDataFrame([("s", "a", 0, 10, "accepted"), ("s", "b", 5, 200, "accepted"), ("t", "c", 0, 1, "accepted"), ("s", "d", 0, 5, "rejected")], WINS + ", status string")
    songs = spark.createDataFrame([("s", "p", "h", 100)], "song_id string, path string, sha256 string, extent long")
    ok, no, issues, diff = jobs.freeze(w, songs, spark.createDataFrame([("p", "other")], "path string, sha256 string"))
    assert rows(ok, "clip_id") == [("a",)] and rows(no, "clip_id") == [("d",)]
    assert rows(issues, "clip_id", "issue") == [("b", "WINDOW_BEYOND_SOURCE"), ("c", "SONG_MISSING")] and rows(diff, "kind") == [("sha256_mismatch",)]


def test_pronunciation_candidates_job(spark):
    df = spark.createDataFrame([("s", "p1", "か", "", ["k", "a"]), ("s", "p2", "hey", "", ["h", "e"])], "song_id string, phrase_id string, surface string, reading string, tk array<string>")
    over = spark.createDataFrame([("hey", "a SP")], "key string, value string")
    got = {r["phrase_id"]: r for r in jobs.pronunciation_candidates(df, F.col("tk"), ["k", "a"], over).collect()}
    assert got["p1"]["phones"] == ["k", "a"] and got["p1"]["review_flags"] == []
    assert got["p2"]["phones"] == ["a", "SP"] and got["p2"]["review_flags"] == ["latin_text", "explicit_lexicon_override"]


def test_short_numbers_are_written_as_by_printf(spark):
    given = [0.0, -0.0, 1.0, 100.0, 0.1, 1 / 3, 2 / 3e5, 1e-4, 9.99999e-5, 123456789.123456, 9999999999.4, 9999999999.9, 1e10, 1.5e-9, -2.5, -1e12, 1e300]
    df = spark.createDataFrame([(v,) for v in given], "v double")
    assert [r[0] for r in df.select(fn.short_number(F.col("v"))).collect()] == [f"{v:.10g}" if v else "0" for v in given]
