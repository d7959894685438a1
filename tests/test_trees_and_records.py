"""Hash trees and their difference, and CSV records over split lines."""

import csv
import io
import itertools

import pytest
from pyspark.sql import functions as F

from tessitura.operators import trees as tr
from tessitura.sources import readers
from tessitura.sources.records import csv_fields, csv_records, csv_table

PAIRS = "path string, sha256 string"


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def members(spark, n, changed=()):
    return spark.range(n).select(F.concat(F.lit("p"), "id").alias("path"), F.concat(F.when(F.col("id").isin(*changed) if changed else F.lit(False), "x").otherwise("h"), "id").alias("sha256")).repartition(5)


def test_depth_follows_the_number_of_members(spark):
    assert [tr.tree_depth(n) for n in (0, 64, 65, 1024, 1025, 10**12)] == [0, 0, 1, 1, 2, 9]
    levels = tr.hash_tree(members(spark, 3000), tr.tree_depth(3000))
    assert [df.count() for df in levels] == [1, 16, 256] and levels[-1].agg(F.max("members")).first()[0] < 64


def test_fingerprint_knows_content_only(spark):
    base = tr.tree_fingerprint(members(spark, 500)).first()
    same = tr.tree_fingerprint(members(spark, 500).unionByName(members(spark, 100)).orderBy(F.desc("path"))).first()
    other = tr.tree_fingerprint(members(spark, 500, [77])).first()
    assert base == same and base["members"] == 500 and base["depth"] == 1 and other["fingerprint"] != base["fingerprint"]
    assert tr.tree_fingerprint(members(spark, 0)).count() == 0


@pytest.mark.parametrize("n", [3, 2000])
def test_diff_is_the_full_anti_join(spark, n):
    left, right = members(spark, n), members(spark, n + 2, [1])
    assert plain(tr.tree_diff(left, right)) == sorted([("p1", "h1", "REMOVED"), ("p1", "x1", "ADDED"), (f"p{n}", f"h{n}", "ADDED"), (f"p{n + 1}", f"h{n + 1}", "ADDED")], key=str)
    assert tr.tree_diff(left, left).count() == 0
    none = members(spark, 0)
    assert tr.tree_diff(none, left).where("state = 'ADDED'").count() == n and tr.tree_diff(left, none).where("state = 'REMOVED'").count() == n


def test_record_fingerprint_ignores_column_order(spark):
    row = spark.createDataFrame([(1, "x")], "b long, a string")
    assert row.select(tr.record_fingerprint("b", "a") == tr.record_fingerprint("a", "b")).first()[0]


CSV = '﻿name,text,n\r\nA,"one, ""two""\nthree\n\nfour",1\n\nB,plain,2\n"C","",3\nA,x,4\n , y ,5\nD,z\nE,z,6,7\n'


def lines_of(spark, text, file="f"):
    return spark.createDataFrame([(file, k + 1, v) for k, v in enumerate(text.split("\n"))], "file string, line long, value string").repartition(4)


@pytest.mark.parametrize("limit", [4_000_000, 5])
def test_records_equal_the_csv_module(spark, limit):
    spark.conf.set("spark.tessitura.maxRowsPerTask", str(limit))
    records, issues = csv_records(lines_of(spark, CSV))
    got = [r["fields"] for r in records.orderBy("record").collect()]
    spark.conf.unset("spark.tessitura.maxRowsPerTask")
    want = [r for r in csv.reader(io.StringIO(CSV.removeprefix("﻿"))) if r]
    assert got == want and issues.count() == 0
    table, problems = csv_table(records, ["n", "name", "absent"], "name")
    assert plain(table.select("n", "name", "absent"))[:2] == [("1", "A", None), ("2", "B", None)] and table.count() == 7
    assert plain(problems.select("line", "type")) == sorted([(2, "DUPLICATE_KEY"), (9, "DUPLICATE_KEY"), (10, "BLANK_KEY"), (11, "MISSING_FIELDS"), (12, "EXTRA_FIELDS")], key=str)


def test_open_quotes_are_reported(spark):
    both = lines_of(spark, 'a,b\n1,"x\ny', "bad").unionByName(lines_of(spark, 'a,b\n1,"x\ny"', "good"))
    records, issues = csv_records(both)
    assert plain(issues) == [("bad", 2, "UNCLOSED_QUOTE")] and records.where("record = 1").count() == 2


@pytest.mark.parametrize("text", ["x" * 60_000, '"' * 30_000, 'a"b,\n' * 12_000])
def test_long_quoted_fields(spark, text):
    """A field's length is no depth of recursion (F1: keys by file, F2: rows)."""
    body = text.replace('"', '""')
    records, issues = csv_records(lines_of(spark, f'role,text\nu,"{body}"\nu,"{body}"'))
    table, problems = csv_table(records, ["role", "text"], "role")
    assert [tuple(r) for r in table.select("role", "text").collect()] == [("u", text)] * 2 and issues.count() == 0
    assert problems.where("type = 'DUPLICATE_KEY'").join(table, ["file", "line"]).count() == 2


def test_fields_of_odd_quotes(spark):
    """What the plain pattern finds, in well and badly quoted records of all short texts."""
    rows = spark.createDataFrame([("".join(c),) for n in range(8) for c in itertools.product('",a', repeat=n)], "text string")
    plain_found = F.regexp_extract_all(F.concat(F.lit(","), "text"), F.lit(',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    inner = lambda x: F.replace(F.substring(x, 2, F.length(x) - 2), F.lit('""'), F.lit('"'))
    want = F.transform(plain_found, lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1), inner(x)).otherwise(x))
    assert rows.where(csv_fields(F.col("text")) != want).count() == 0


def test_read_csv_keeps_quoted_line_ends(spark, tmp_path):
    (tmp_path / "t.csv").write_text(CSV, encoding="utf-8")
    rows = readers.read_csv(spark, str(tmp_path / "t.csv"), ["name", "text"])
    assert rows.where("n is null" if "n" in rows.columns else "name = 'A'").count() == 2
    assert rows.where("name = 'A' and text like 'one%'").first()["text"] == 'one, "two"\nthree\n\nfour'
    assert readers.read_csv(spark, str(tmp_path / "t.csv")).columns == ["name", "text", "n"]
