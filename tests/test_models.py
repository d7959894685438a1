"""User scorers and token providers: once per distinct text, errors and refusals fall back."""

import pathlib
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessitura.functions.models import with_model
from tessitura.plans.jobs import provided_candidates


def counting(folder, kind):
    """A provider that leaves one file per call, holding the texts it was asked for."""

    def note(name, texts):
        (pathlib.Path(folder) / f"{kind}-{name}-{uuid.uuid4().hex}").write_text("\n".join(texts))

    def load():
        note("load", [])
        return 10.0

    def apply(model, texts):
        if any(t == "boom" for t in texts):
            raise RuntimeError("no such word")
        note("apply", texts)
        return pd.Series([None if t == "refuse" else len(t) / model for t in texts], dtype=object)

    return load, apply


def asked(folder):
    return [t for p in folder.glob("*-apply-*") for t in p.read_text().split("\n")]


def test_each_distinct_text_is_scored_once(spark, tmp_path):
    texts = ["hot"] * 300 + ["a", "bb", "", None, "refuse", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(6)
    load, apply = counting(str(tmp_path), "s")
    got = {r["id"]: r for r in with_model(df, "text", load, apply, "double", F.lit(-1.0), "score").collect()}
    assert len(got) == len(texts) and sorted(asked(tmp_path)) == sorted(["hot", "a", "bb", "", "refuse"])
    assert got[0]["score"] == got[299]["score"] == 0.3 and got[301]["score"] == 0.2 and got[302]["score"] == 0.0
    assert (got[304]["score"], got[304]["score_status"]) == (-1.0, "RULE_REFUSED")
    assert (got[303]["score"], got[303]["score_status"]) == (got[305]["score"], got[305]["score_status"]) == (-1.0, "RULE_EMPTY")


def test_an_error_costs_only_its_own_text(spark, tmp_path):
    df = spark.createDataFrame([("boom",), ("fine",), ("boom",)], "text string").coalesce(1)
    load, apply = counting(str(tmp_path), "e")
    got = with_model(df, "text", load, apply, "double", F.length("text").cast("double"), "score").collect()
    assert sorted((r["text"], r["score"], r["score_status"], r["score_error"]) for r in got) == [
        ("boom", 4.0, "RULE_FAILED", "RuntimeError: no such word"), ("boom", 4.0, "RULE_FAILED", "RuntimeError: no such word"), ("fine", 0.4, "MODEL", None)
    ]


def test_empty_table_and_taken_names(spark, tmp_path):
    load, apply = counting(str(tmp_path), "n")
    df = spark.createDataFrame([], "text string, `odd.name` long")
    out = with_model(df, "text", load, apply, "double", F.lit(0.0), "score")
    assert out.collect() == [] and out.columns == ["text", "odd.name", "score", "score_status", "score_error"]
    with pytest.raises(ValueError):
        with_model(df.withColumn("score_error", F.lit(1)), "text", load, apply, "double", F.lit(0.0), "score")


def test_token_provider(spark):
    lyrics = spark.createDataFrame([("s", 0, "ka", ""), ("s", 1, "", "kN"), ("t", 0, "ka", ""), ("t", 1, "??", "")], "song_id string, phrase_id long, surface string, reading string")

    def split(_, texts):
        if "??" in set(texts):
            raise KeyError("??")
        return texts.map(list)

    got = {(r["song_id"], r["phrase_id"]): r for r in provided_candidates(lyrics, lambda: None, split, ["k", "a", "ɴ"]).collect()}
    assert got["s", 0]["phones"] == got["t", 0]["phones"] == ["k", "a"] and got["s", 1]["phones"] == ["k", "ɴ"]
    assert got["t", 1]["provider_status"] == "RULE_FAILED" and got["t", 1]["phones"] == [] and got["s", 0]["provider_status"] == "MODEL"
