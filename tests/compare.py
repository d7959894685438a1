"""Compare a registered Spark query with its SQL text run by DuckDB on the same tables."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def differences(query, tables, con) -> list[str]:
    """Empty when columns, value types and the bag of rows are equal."""
    df = query.build(tables)
    cols = sorted(df.columns)
    spark_rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    raw = cur.fetchall()
    if sorted(names) != cols:
        return [f"columns {cols} != {sorted(names)}"]
    place = [names.index(c) for c in cols]
    duck_rows = [tuple(_norm(r[i]) for i in place) for r in raw]
    problems = []
    for i, c in enumerate(cols):
        st = {type(r[i]) for r in spark_rows} - {type(None)}
        dt = {type(r[i]) for r in duck_rows} - {type(None)}
        if st and dt and st != dt:
            problems.append(f"types of {c}: {st} != {dt}")
    a, b = Counter(spark_rows), Counter(duck_rows)
    if a != b:
        problems.append(
            f"rows {len(spark_rows)} vs {len(duck_rows)}; only spark {list((a - b).items())[:3]}; "
            f"only sql {list((b - a).items())[:3]}; cols {cols}"
        )
    if not spark_rows:
        problems.append("no rows")
    return problems


def main(folder: str, wanted: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    from tessitura.plans.catalogue import QUERIES
    from tessitura.plans.views import Tables
    from tessitura.session import local_session

    spark, con = local_session(8), connect(folder)
    limit = os.environ.get("MAX_ROWS")
    if limit:  # force the chunked route
        spark.conf.set("spark.tessitura.maxRowsPerTask", limit)
    tables, bad = Tables(spark, folder), 0
    for name, q in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        t0 = time.time()
        try:
            if q.sql is None:
                n = q.build(tables).count()
                print(f"ROWS {name} {n} {time.time() - t0:.1f}s", flush=True)
                continue
            found = differences(q, tables, con)
        except Exception as exc:  # report and go on with the next query
            found = [repr(exc)[:1500]]
        bad += bool(found)
        print(("BAD  " if found else "ok   ") + name, f"{time.time() - t0:.1f}s", *found, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
