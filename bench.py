"""Time every query once per round at ``$BENCH_SF_DIR`` and print one JSON line.

Each query is written to Spark's no-op sink, so all its rows are computed. The
value is the sum of the queries' best times over ``$BENCH_ROUNDS`` rounds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airq.session import local_session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(name="airq-bench")
    best: dict[str, float] = {}
    for _ in range(int(os.environ.get("BENCH_ROUNDS", "2"))):
        for name in names:
            start = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best[name] = min(took, best.get(name, took))
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of query wall times", "value": round(sum(best.values()), 3), "unit": "sec",
        "queries": {n: round(t, 3) for n, t in best.items()}, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
