"""Packing, whitening and the Merkle manifest against direct versions, with awkward rows."""

import functools
import hashlib
import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from helpers import DOCS, SF, docs, odd_rows, plain, with_extra_columns
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessitura.llm import manifest_tree, packing, whitening
from tessitura.llm.common import table
from tessitura.llm.token_files import encode_texts, vocabulary_file


# -- token ids --------------------------------------------------------------------


def test_ids_of_words_are_those_of_whole_texts():
    marks = [chr(c) for c in range(0x3010) if not 0xD800 <= c < 0xE000]
    texts = [f"ab{c}cd.{c}{c}Ef{c}" for c in marks]
    texts += ["don't 'stop' O'Neil's <|endoftext|> a<|endoftext|>,", "x²y ½ 3km", "ÀÉÎ...!? İstanbul ſtop ẞ ŉ", "abc''. abc.'s end.\"'", "", "   ", "\x1c a\x1fb"]
    want = [np.array(TOKENIZER.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert encode_texts(texts, vocabulary_file()) == want


# -- packing ----------------------------------------------------------------------


TOKENIZER = Tokenizer.from_file(vocabulary_file())


@functools.lru_cache(maxsize=10_000)
def ids_of(text):
    return (*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1)


def check_pieces(rows, texts, length):
    """Pieces cover each document once and each sequence from 0; returns the sequence sizes."""
    per_doc, per_sequence, by_id = defaultdict(list), defaultdict(list), defaultdict(Counter)
    for i, t in texts:
        by_id[i][ids_of(t)] += 1
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"] > 0 and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        per_doc[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        per_sequence[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_tokens"]))
    for doc_id, pieces in per_doc.items():
        wanted = by_id[doc_id]
        if sum(wanted.values()) == 1:
            (whole,) = wanted
            assert [x for _, ids, _ in sorted(pieces) for x in ids] == list(whole) and {p[2] for p in pieces} == {len(whole)}
        assert sum(len(p[1]) for p in pieces) == sum(len(k) * n for k, n in wanted.items())
    assert set(per_doc) == {i for i, _ in texts}
    for pieces in per_sequence.values():
        at = 0
        for offset, n, total in sorted(pieces):
            assert offset == at
            at += n
        assert at == pieces[0][2] <= length
    return {k: v[0][2] for k, v in per_sequence.items()}


@pytest.mark.parametrize("clash", [False, True])
def test_packing_keeps_every_id_once(spark, clash):
    rows = odd_rows() + [(1000 + k, " ".join(["word"] * (k % 37))) for k in range(300)]
    frame = docs(spark, rows)
    found = packing.pack(with_extra_columns(frame) if clash else frame, length=64, windows=4, least=3, keep_ids=True).collect()
    sizes = check_pieces(found, rows, 64)
    assert sum(n < 62 for n in sizes.values()) <= 1  # but for the last, at most ``least`` - 1 ids of padding


def test_open_windows_are_bounded_and_best_fit_is_taken():
    state, closed = packing.OpenWindows(100, 2, 10), []
    place = lambda name, n: closed.extend(state.add(name, np.zeros(n, dtype=np.uint32)))
    place(1, 60)
    place(2, 75)
    place(3, 20)  # fits both, best behind 2
    assert [[(p[0], len(p[2])) for p in w] for w in state.held.values()] == [[(1, 60)], [(2, 75), (3, 20)]]
    place(4, 50)  # fits none: window 2 is the fullest and, with room 5 < least, stays padded
    assert [[p[0] for p in pieces] for _, pieces in closed] == [[2, 3]] and len(state.held) == 2
    place(5, 70)  # fits none: the fullest (room 40) takes the head, the rest goes on
    assert [(p[0], p[1], len(p[2])) for p in closed[-1][1]] == [(1, 0, 60), (5, 0, 40)]
    place(6, 250)
    assert [len(w[1]) for w in closed[2:4]] == [1, 1] and len(state.held) <= 2
    rng = np.random.default_rng(5)
    for k in range(2000):
        place(10 + k, int(rng.integers(1, 300)))
        assert len(state.held) <= 2
    assert all(sum(len(p[2]) for p in pieces) > 100 - 10 for _, pieces in closed)


def test_packing_edges(spark):
    none = docs(spark, [(1, "x")]).filter("false")
    assert packing.pack(none).count() == 0
    rows = [(k, "one hot text") for k in range(3000)] + [(9999, None)]
    found = packing.pack(docs(spark, rows), length=128, keep_ids=True)
    joined = {r["sequence_id"]: r for r in packing.sequences(found).collect()}
    sizes = check_pieces(found.collect(), rows, 128)
    assert {k: len(r["ids"]) // 4 for k, r in joined.items()} == sizes and all(sum(r["lengths"]) == sizes[k] for k, r in joined.items())
    lengths = spark.createDataFrame([(1,), (3,), (1024,), (2047,), (2048,)], "t long").select(packing.padded_length(F.col("t")))
    assert [r[0] for r in lengths.collect()] == [1, 2048, 1024, 2048, 2048]


def test_packing_query(spark):
    found = packing.op11_packing(spark, SF).toPandas()
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    for doc_id, pieces in found.groupby("doc_id"):
        ids = np.array(ids_of(texts[doc_id]), dtype="<u4")
        pieces = pieces.sort_values("start")
        assert pieces.start.tolist() == [0, *pieces.length.cumsum()[:-1]] and pieces.length.sum() == len(ids) == pieces.doc_tokens.iloc[0]
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in zip(pieces.start, pieces.length, pieces.ids_crc32))
    sizes = found.groupby("sequence_id").agg(n=("length", "sum"), padded=("padded_length", "first"))
    assert sizes.padded.sum() - sizes.n.sum() <= 2047 + 7 * len(sizes)


# -- whitening --------------------------------------------------------------------


def direct(rows):
    """Plain numpy version over ``(id, vector)``: n, deviations by position, whitened, explained."""
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows], dtype=np.int64)
    n = len(x)
    away = n * x - x.sum(0)
    around = x - x.mean(0)
    values, axes = np.linalg.eigh(around.T @ around / n)
    values, axes = values[::-1], axes[:, ::-1]
    return n, (away**2).sum(1), around @ axes / np.sqrt(np.maximum(values, 1e-300)), values / values.sum()


@pytest.mark.parametrize("clash", [False, True])
def test_whitening_against_numpy(spark, clash):
    rng = np.random.default_rng(2)
    good = [(k, [float(np.float32(x)) for x in rng.normal(size=10) * np.arange(1, 11) / 7]) for k in range(300)]
    good += [(5, good[5][1]), (None, good[6][1])]
    bad = [(900, None), (901, [None] * 10), (902, [0.1] * 9 + [None]), (903, [float("nan")] * 10), (904, [float("inf")] + [0.0] * 9), (905, []), (906, [0.5] * 9), (907, [1e300] * 10)]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").repartition(5)
    frame = frame.withColumns({c: F.lit("clash") for c in ("n", "key", "vec", "a", "component")}) if clash else frame
    model = whitening.fit(frame)
    found = whitening.whiten(frame, model).collect()
    n, far, white, explained = direct(good)
    assert model.n == n and Counter((r["vec_id"], r["component"]) for r in found) == Counter((i, c) for i, _ in good for c in range(1, 9))
    first = [r for r in found if r["vec_id"] == 7]
    sign = {r["component"]: np.sign(r["whitened"] * white[7, r["component"] - 1]) for r in first}
    places = {i: k for k, (i, _) in enumerate(good)}
    for r in found:
        k, c = places[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == far[k] and r["n"] == n
        assert abs(r["whitened"] * sign[r["component"]] - white[k, c]) < 1e-9 and abs(r["explained"] - explained[c]) < 1e-12
    assert whitening.identity_error(frame, "embedding", model) < 1e-9


def test_covariance_is_exact_far_from_zero(spark):
    """Values whose plain squares would lose the spread: 2 ** 40 and a few steps."""
    steps = [(0, 0), (1, 3), (2, 1), (5, 5), (7, 0)]
    frame = spark.createDataFrame([(k, [float(2**30 + a / 1024), float(b / 1024)]) for k, (a, b) in enumerate(steps)], "vec_id long, embedding array<double>")
    total = whitening.sums(frame, "embedding", 2)
    n, s = total
    centre = [(2 * v + n) // (2 * n) for v in s]
    matrix = whitening.covariance(n, s, centre, whitening.squares(frame, "embedding", centre))
    mean = [Fraction(sum(c), 5) for c in zip(*steps)]
    exact = [[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in steps) / 5) for j in range(2)] for i in range(2)]
    assert matrix.tolist() == exact


def test_whitening_edges(spark, tmp_path):
    kind = "vec_id long, embedding array<float>"
    assert whitening.fit(spark.createDataFrame([], kind)) is None
    equal = spark.createDataFrame([(k, [0.5, 0.25]) for k in range(20)], kind)
    assert len(whitening.fit(equal).variances) == 0
    flat = spark.createDataFrame([(k, [k / 8, k / 4, 1.0]) for k in range(20)], kind)
    model = whitening.fit(flat)
    assert len(model.variances) == 1 and whitening.whiten(flat, model).count() == 20
    for k, frame in enumerate([equal, spark.createDataFrame([], kind)]):
        frame.write.parquet(f"{tmp_path}/{k}/embeddings.parquet")
        assert whitening.op12_whitening(spark, f"{tmp_path}/{k}").count() == 0
    assert whitening.op12_whitening(spark, SF).filter("identity_error > 0.0001").count() == 0


# -- Merkle manifest ----------------------------------------------------------------


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, lower=False):
    text = row[4].translate({k: k + 32 for k in range(65, 91)}) if lower and row[4] is not None else row[4]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[1], text)))


def tree(nodes):
    """Root and, per node, the ``(before, after)`` pairs from the bottom."""
    paths, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 16, len(nodes))) for a in range(0, len(nodes), 16)]
        for run in runs:
            for k in run:
                for leaf in groups[k]:
                    paths[leaf].append(("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)))
        groups = [[x for k in run for x in groups[k]] for run in runs]
        nodes = [h("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], paths


def brute_manifest(rows):
    """Rows ``(doc_id, n_chars, lang, source, text)``."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[3]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order]
    root, tops = tree([t[0] for t in trees])
    out = []
    for s, (sub, paths), top in zip(order, trees, tops):
        for (_, _, leaf, row), path in zip(sorted(sources[s], key=lambda x: x[:3]), paths):
            shown = leaf_of(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0)
            for before, after in [*path, *top]:
                shown = h(before + shown + after)
            out.append((row[0], leaf, sub, root, h("".join(b + a for b, a in [*path, *top])), shown, shown == root))
    return sorted(out, key=str)


def wide(rows):
    """``(doc_id, text)`` rows over sources of very different sizes, with nulls in all columns."""
    out = []
    for k, (i, t) in enumerate(rows):
        source = "hot" if k % 3 else f"s{k % 60:02d}"
        out.append((i, None if k % 7 == 0 else len(t or ""), None if k % 11 == 0 else "en", None if k % 50 == 0 else "" if k % 51 == 0 else source, t))
    return out


@pytest.mark.parametrize("clash", [False, True])
def test_manifest_against_direct_version(spark, clash, tmp_path):
    rows = wide(odd_rows() + [(50 + k, f"Text No {k}") for k in range(700)] + [(9000, "Equal")] * 40)
    made = spark.createDataFrame([(r[0], r[4], r[2], r[3], r[1]) for r in rows], DOCS).repartition(4)
    for c in ("s", "r", "i", "n", "leaf", "shown", "root", "_src", "_tie", "_range", "digest") if clash else ():
        made = made.withColumn(c, F.lit("clash"))
    made.write.parquet(f"{tmp_path}/documents.parquet")
    assert plain(manifest_tree.op13_merkle(spark, str(tmp_path))) == brute_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_manifest_of_one_source(spark, n, tmp_path):
    rows = [(k, 3, "en", "s", f"Row {k}") for k in range(n)]
    spark.createDataFrame([(r[0], r[4], r[2], r[3], r[1]) for r in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert plain(manifest_tree.op13_merkle(spark, str(tmp_path))) == brute_manifest(rows)


def test_some_leaves_descend_alone(spark, tmp_path):
    frame = docs(spark, [(k, f"Text {k}") for k in range(600)])
    manifest = manifest_tree.build(manifest_tree.document_leaves(frame), str(tmp_path / "graph"))
    everyone = manifest_tree.proofs(spark, manifest)
    wanted = everyone.filter("doc_id in (3, 4, 599)").select("s", "r")
    some = manifest_tree.proofs(spark, manifest, wanted)
    assert plain(some) == plain(everyone.filter("doc_id in (3, 4, 599)")) and some.count() == 3


def test_manifest_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert manifest_tree.op13_merkle(spark, str(tmp_path)).count() == 0


def test_manifest_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert plain(manifest_tree.op13_merkle(spark, SF)) == sorted(con.execute(manifest_tree.OP13_SQL).fetchall(), key=str)
