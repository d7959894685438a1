"""Toxicity and quality on held-out rows, kernels by definition, awkward rows and label tables."""

import itertools
import random
import zlib

import numpy as np
import pytest
from helpers import docs, odd_rows, with_extra_columns
from pyspark.sql import functions as F

from tessitura.llm import quality, toxicity
from tessitura.llm.common import held_out


def labelled_corpus(spark, n=400):
    rnd = random.Random(1)
    syllables = ["ta", "re", "mi", "no", "lu", "sha", "ven", "dor", "pel", "qui"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3)))
    rows, marks = [], []
    for k in range(n):
        text = [" ".join(word() for _ in range(rnd.randint(5, 12))) + "." for _ in range(rnd.randint(1, 6))]
        toxic, good = int(k % 4 == 0), int(k % 3 > 0)
        if toxic:
            s = rnd.randrange(len(text))
            text[s] = text[s].replace(" ", f" {rnd.choice(['blockhead', 'nitwit', 'dunce'])} ", 1)
        if not good:
            text = [x.upper() + "!!" if k % 2 else " ".join([x.split()[0]] * 40) for x in text]
            text = text if not toxic else [*text, "blockhead."]
        rows.append((k, " ".join(text)))
        marks.append((k, good, toxic))
    return docs(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), rows


def test_held_out_is_the_crc_rule(spark):
    got = {r["id"]: r["held"] for r in spark.range(200).select("id", held_out(F.col("id")).alias("held")).collect()}
    assert got == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in range(200)}


def brute_kernel(a, b):
    def features(w):
        out, norm, letters = {}, 0.0, toxicity._letters([w], len(w))[0]
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < toxicity.SPAN and min(letters[[i, j, k]]) > 0:
                weight = toxicity.DECAY ** (k - i + 1)
                key = tuple(letters[[i, j, k]])
                out[key] = out.get(key, 0.0) + weight
                norm += weight**2
        return {x: v / max(norm, 1e-24) ** 0.5 for x, v in out.items()}

    fa, fb = features(a), features(b)
    return sum(v * fb.get(x, 0.0) for x, v in fa.items()) ** toxicity.POWER


def test_kernel_equals_its_definition_and_tolerates_gaps():
    words = ["idiot", "idi-ot", "idioot", "ox", "", "stupendous", "épée", "a1b2c3", "longer-word-with-many-parts"]
    got = toxicity.Kernel(words)(words)
    want = [[brute_kernel(a, b) for b in words] for a in words]
    assert np.allclose(got, want, atol=1e-4)
    assert got[0, 1] > 0.4 and got[0, 2] > 0.4 > 0.01 > got[0, 5]


def test_sentences_join_spelt_words_and_have_a_length():
    words, starts = toxicity.words_of("You i d i o t. " + "word " * 70)
    assert "idiot." not in words[:1] and "idio" in words[1] and max(np.diff([*starts, len(words)])) <= toxicity.SENTENCE


def test_toxicity_on_held_out_rows(spark):
    table, labels, rows = labelled_corpus(spark)
    machine = toxicity.fit(with_extra_columns(table), labels)
    found = {r["doc_id"]: r for r in toxicity.score(with_extra_columns(table), machine).collect()}
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in found if found[i]["held_out"]]
    assert len(held) > 60 and np.mean([found[i]["predicted"] == marks[i] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    clean = toxicity.keep_clean(table, machine)
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == {i for i, r in found.items() if not r["predicted"]}
    # Inserted characters and spelt-out letters are still met; harmless words are not.
    scores = machine.scores(["ta re mi no block-head lu sha.", "ta re d u n c e no lu sha.", "ta re mi no quimi lu sha.", "", "   "])
    assert scores[0] >= 0.3 and scores[1] >= 0.3 and (scores[2:] < 0.3).all()
    # A text is judged as a whole: far behind a long clean part, too.
    assert machine.scores(["ta re mi no. " * 6000 + "you dunce."])[0] >= 0.3


def test_quality_on_held_out_rows(spark):
    table, labels, _ = labelled_corpus(spark)
    ranking = quality.fit(with_extra_columns(table), labels)
    found = {r["doc_id"]: r for r in quality.score(table, ranking).collect()}
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [i for i in found if found[i]["held_out"]]
    assert np.mean([found[i]["predicted"] == marks[i] for i in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found.values())


def test_pairs_rank_a_planted_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, quality.N_FEATURES))
    y = (x[:, 3] - 0.5 * x[:, 5] > 0).astype(int)
    raw = quality.rank_pairs(x, y).raw(x)
    assert ((raw > 0) == (y == 1)).mean() > 0.97 and np.corrcoef(raw, x[:, 3] - 0.5 * x[:, 5])[0, 1] > 0.95


def test_fits_do_not_see_held_out_labels(spark):
    table, labels, _ = labelled_corpus(spark, 120)
    turned = labels.withColumn("toxic", F.expr("case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - toxic else toxic end"))
    a, b = toxicity.fit(table, labels), toxicity.fit(table, turned)
    assert a.landmarks == b.landmarks and np.allclose(a.weights, b.weights) and a.scale == b.scale


@pytest.mark.parametrize("kind", ["none", "one label", "odd labels"])
def test_awkward_labels_and_rows(spark, kind):
    marks = {"none": [], "one label": [(1, 1, 1), (2, 1, 1), (4, 1, 1)], "odd labels": [(1, None, 0), (1, 0, 1), (None, 1, 1), (4, 7, -1), (6, 1, 0), (9, 1, 0)]}[kind]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    table = docs(spark, odd_rows())
    for made in (toxicity.score(table, toxicity.fit(table, labels)), quality.score(table, quality.fit(table, labels))):
        found = made.collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in odd_rows())
        assert all(0 <= r["score"] <= 1 for r in found)
    none = table.filter("false")
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0 and quality.score(none, quality.fit(none, labels)).count() == 0
