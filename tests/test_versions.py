"""Versions by manifest, races, repeated runs, and lists in order over many files."""

import glob
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from tessitura.operators import manifest as mf
from tessitura.sources import sinks, versions


def table(spark, rows):
    return spark.createDataFrame(rows, "song string, n long, text string")


def doubled(rows):
    return rows.withColumn("n", F.col("n") * 2)


def rows_of(spark, root, version=None):
    return sorted(map(tuple, versions.read_version(spark, root, version).select("song", "n", "text").collect()), key=repr)


FIRST = [("a", 1, "x"), ("a", 1, "x"), ("b", 2, None), (None, 3, "")]


def test_only_changed_keys_are_built(spark, tmp_path):
    root = str(tmp_path / "v")
    assert versions.publish_changed(table(spark, FIRST), root, ["song"], doubled) == {"status": "PUBLISHED", "failed": [], "version": 1, "built": 3}
    later = [("a", 1, "x"), ("a", 1, "x"), ("b", 2, ""), ("c", 4, "y")]
    assert versions.publish_changed(table(spark, later), root, ["song"], doubled)["built"] == 2  # b and c; the null key is gone
    assert versions.publish_changed(table(spark, later[::-1]), root, ["song"], doubled)["built"] == 0
    twice = lambda rows: sorted(((s, 2 * n, t) for s, n, t in rows), key=repr)
    assert rows_of(spark, root, 1) == twice(FIRST)
    assert rows_of(spark, root, 2) == rows_of(spark, root) == twice(later)


def test_fingerprint_sees_every_change(spark):
    def of(rows):
        return {r["song"]: r["input_fingerprint"] for r in versions.fingerprints(table(spark, rows), ["song"]).collect()}

    base = of([("a", 1, "x"), ("a", 2, "y")])
    assert base == of([("a", 2, "y"), ("a", 1, "x")])
    for other in ([("a", 1, "y"), ("a", 2, "x")], [("a", 1, "x")], [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y")], [("a", 1, "x"), ("a", 2, None)], [("a", 1, "x"), ("a", None, "y")]):
        assert of(other) != base


def test_race_has_one_winner_and_loses_no_rows(spark, tmp_path):
    root, start, seen = str(tmp_path / "v"), threading.Barrier(2), {}

    def checks(rows):
        start.wait(120)  # both have written their rows before either looks for the manifest
        return rows.sparkSession.createDataFrame([("OK", 0, True)], "code string, failures long, passed boolean")

    def go(name):
        try:
            seen[name] = versions.publish_changed(table(spark, [(name, i, name) for i in range(50)]), root, ["song"], doubled, checks=checks)
        except FileExistsError as exc:
            seen[name] = exc

    both = [threading.Thread(target=go, args=(n,)) for n in ("p", "q")]
    [t.start() for t in both]
    [t.join() for t in both]
    won = [n for n in seen if isinstance(seen[n], dict)]
    assert len(won) == 1 and isinstance(seen[({"p", "q"} - set(won)).pop()], FileExistsError)
    assert rows_of(spark, root) == sorted([(won[0], 2 * i, won[0]) for i in range(50)], key=repr)
    # The other one publishes on top of it and builds its own rows only.
    lost = ({"p", "q"} - set(won)).pop()
    all_rows = [(n, i, n) for n in ("p", "q") for i in range(50)]
    assert versions.publish_changed(table(spark, all_rows), root, ["song"], doubled)["built"] == 1
    assert rows_of(spark, root) == sorted([(n, 2 * i, t) for n, i, t in all_rows], key=repr) and lost in {r[0] for r in rows_of(spark, root)}


def test_failed_check_and_crash_publish_nothing(spark, tmp_path):
    root = str(tmp_path / "v")
    bad = lambda rows: rows.agg(F.lit("EMPTY_TEXT").alias("code"), F.count_if(F.col("text").isNull()).alias("failures")).withColumn("passed", F.col("failures") == 0)
    assert versions.publish_changed(table(spark, FIRST), root, ["song"], doubled, checks=bad)["failed"] == ["EMPTY_TEXT"]

    def crash(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versions.publish_changed(table(spark, FIRST), root, ["song"], crash)
    assert versions.latest(spark, root) == 0
    assert versions.publish_changed(table(spark, FIRST), root, ["song"], doubled, version=1)["built"] == 3
    with pytest.raises(FileExistsError):
        versions.publish_changed(table(spark, FIRST), root, ["song"], doubled, version=1)
    with pytest.raises(ValueError):
        versions.publish_changed(table(spark, FIRST).withColumn("file_set", F.lit(1)), root, ["song"], doubled)
    assert len(os.listdir(f"{root}/manifests")) == 1
    assert json.load(open(f"{root}/manifests/00000001.json"))["keys"] == ["song"]


def test_empty_version(spark, tmp_path):
    root = str(tmp_path / "v")
    versions.publish_changed(table(spark, FIRST), root, ["song"], doubled)
    assert versions.publish_changed(table(spark, []), root, ["song"], doubled)["built"] == 0
    assert rows_of(spark, root, 1) and rows_of(spark, root) == []


def lines(path):
    return [x for f in sorted(glob.glob(f"{path}/part-*")) for x in open(f, encoding="utf-8").read().splitlines()]


def test_mixed_list_keeps_first_places(spark, tmp_path):
    """Many files, read one after another, equal what one task would write."""
    one = [f"w/{i * 7 % 500:03d}.wav" for i in range(500)]
    two = [f"w/{i * 11 % 800:03d}.wav" for i in range(800)] + ["w/000.wav", None, ""]
    want = list(dict.fromkeys(p for p in one + two if p))
    frames = [spark.createDataFrame(list(enumerate(x)), "at long, path string").repartition(7, "path") for x in (one, two)]
    sinks.write_mixed_list(frames, str(tmp_path / "mixed"), "path", "at", parts=5)
    assert lines(tmp_path / "mixed") == want
    assert len(glob.glob(f"{tmp_path}/mixed/part-*")) > 1
    assert mf.ordered_union(frames, "path", "at").count() == len(want) + 2


def test_lists_in_order_over_files(spark, tmp_path):
    rows = spark.createDataFrame([(name, i, f"{name}{i}") for i in range(300) for name in ("train", "validation")], "list string, id long, line string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_lists(rows.repartition(9), str(tmp_path / "lists"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("train", "validation"):
        assert lines(tmp_path / "lists" / f"list={name}") == [f"{name}{i}" for i in range(300)]
    assert len(glob.glob(f"{tmp_path}/lists/list=train/part-*")) > 1
