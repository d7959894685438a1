"""Wall time of every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is planned and run to completion through the noop sink, so all columns of all
rows are computed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tessitura.plans.catalogue import QUERIES
from tessitura.plans.views import Tables
from tessitura.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = local_session(cpus, "bench")
    Tables(spark, folder).notes().count()  # start workers and warm the reader
    seconds = {}
    for name, q in QUERIES.items():
        if wanted and name not in wanted:
            continue
        begin = time.perf_counter()
        q.build(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": folder}))
    spark.stop()


if __name__ == "__main__":
    main()
