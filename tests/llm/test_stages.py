"""Every stage of the pipeline on nulls, ties, repeated rows, an empty table and clashing names."""

import sys

import pytest
from helpers import SF, docs, odd_rows, with_extra_columns
from pyspark.sql import functions as F

sys.path.insert(0, "/root/repo")

import corpus_pipeline  # noqa: E402

CLASHES = ("_key", "_id", "_digest", "_n", "_leak_id", "_leak_digest", "_KEY2", "kept", "doc")


def clashing(frame):
    frame = with_extra_columns(frame)
    for name in CLASHES:
        frame = frame.withColumn(name, F.lit(name)) if name not in frame.columns else frame
    return frame


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[1:4])
def test_clashing_names_change_nothing(spark, name, stage):
    frame = docs(spark, odd_rows() + [(30, "one two three four five six"), (31, None)])
    plain, wide = stage(spark, frame, SF), stage(spark, clashing(frame), SF)
    kept = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert kept(plain) == kept(wide) and 0 < plain.count() <= len(odd_rows()) + 2
    assert set(plain.columns) == set(frame.columns) and set(wide.columns) == set(clashing(frame).columns)
    assert wide.select(*CLASHES).distinct().count() == 1
    nothing = stage(spark, frame.filter("false"), SF)
    assert nothing.count() == 0 and set(nothing.columns) == set(frame.columns)
