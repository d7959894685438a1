"""CSV records over physical lines, for files that are split between tasks.

A line end belongs to a field when the number of quotes before it is odd. So a running
count of quotes per file, over lines in order, tells where records end, wherever the file
was cut; the scan is safe for one very long file. Lines of a record are then joined and
cut into fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scans import refine, running_sum, scan

BOM = "﻿"


def csv_records(lines: DataFrame, sep: str = ",", hot=None) -> tuple[DataFrame, DataFrame]:
    """Records of CSV lines, and issues.

    ``lines``: file, line (from 1), value. Records: file, record (0 is the header), line
    (its first), fields. Quotes count at the start of a field only to its closing quote;
    blank lines outside quotes are no records. Issues: file, line, type UNCLOSED_QUOTE for
    a file whose quotes do not pair.
    """
    value = F.when(F.col("line") == 1, F.regexp_replace("value", f"^{BOM}", "")).otherwise(F.col("value"))
    rows = lines.withColumn("value", F.regexp_replace(value, "\r$", ""))
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("bigint")
    one = lambda test: F.when(test, 1).otherwise(0).cast("bigint")
    before = F.coalesce("__before", F.lit(0))
    blank = (before % 2 == 0) & (F.trim("value") == "")
    numbered = scan(
        rows, ["file"], ["line"], [running_sum("__before", quotes, inclusive=False)], refine(hot, rows, ["file"]),
        [running_sum("record", one((before % 2 == 0) & ~blank))],
    ).where(~blank)
    joined = numbered.groupBy("file", "record").agg(
        F.min("line").alias("line"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n").alias("text"), F.sum(quotes).alias("__q"),
    )
    records = joined.select("file", (F.col("record") - 1).alias("record"), "line", csv_fields(F.col("text"), sep).alias("fields"))
    issues = joined.where(F.col("__q") % 2 == 1).select("file", "line", F.lit("UNCLOSED_QUOTE").alias("type"))
    return records, issues


def csv_fields(text: Column, sep: str = ",") -> Column:
    """Fields of one record; quoted fields lose their quotes, and two quotes in them are one."""
    mark = "\\" + sep if sep in ".|^$*+?()[]{}\\" else sep
    # Possessive, or a field's length is the depth of the matcher's recursion. Where no quote closes the field, its last two quotes are no pair: the first of them ends it.
    quoted = r'"(?:[^"]++|""(?![^"]*+\z))*+"'
    found = F.regexp_extract_all(F.concat(F.lit(sep), text), F.lit(f'{mark}({quoted}|[^{mark}]*+)'), F.lit(1))
    inner = lambda x: F.replace(F.substring(x, 2, F.length(x) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1), inner(x)).otherwise(x))


def csv_table(records: DataFrame, columns: Sequence[str], key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows under their files' headers, all strings, and issues (file, line, type).

    Columns that a header lacks, and fields that a record lacks, are null. Issues:
    EXTRA_FIELDS, MISSING_FIELDS, and for ``key`` BLANK_KEY and DUPLICATE_KEY (within its
    file, on every row that shares it).
    """
    heads = records.where("record = 0").select("file", F.transform("fields", lambda x: F.trim(x)).alias("head"))
    rows = records.where("record > 0").join(heads, "file")
    cell = lambda c: F.get("fields", (F.array_position("head", c) - 1).cast("int"))
    cells = {c: F.when(F.array_position("head", c) > 0, cell(c)) for c in columns}
    table = rows.select("file", "record", "line", *[v.alias(c) for c, v in cells.items()])
    count = F.size("fields") - F.size("head")
    issues = rows.select("file", "line", F.when(count > 0, "EXTRA_FIELDS").when(count < 0, "MISSING_FIELDS").alias("type")).where("type is not null")
    if key:
        name = F.trim(F.coalesce(F.col(key), F.lit("")))
        issues = issues.unionByName(table.where(name == "").select("file", "line", F.lit("BLANK_KEY").alias("type")))
        # Counted before the rows meet their key: a key that fills a file is one row here.
        often = table.where(name != "").groupBy("file", name.alias("__key")).count().where("count > 1").select("file", "__key")
        again = table.withColumn("__key", name).join(often, ["file", "__key"], "left_semi")
        issues = issues.unionByName(again.select("file", "line", F.lit("DUPLICATE_KEY").alias("type")))
    return table, issues
