"""Time the registered queries on the driver tables and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_REPEATS`` (warm runs per query, default 3).

Every query is run once cold, then every query ``BENCH_REPEATS`` times; its figure is the best
warm run, measured from building the DataFrame to the end of ``collect()``.  ``value`` is the sum over
timed the same way and reported under ``other_queries``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dialstat.plans.catalog import HEADLINE, QUERIES  # noqa: E402
from dialstat.session import local_session  # noqa: E402


def _time(spark, fn, sf_dir: str) -> tuple[float, int]:
    t0 = time.perf_counter()
    rows = fn(spark, sf_dir).collect()
    return time.perf_counter() - t0, len(rows)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    load_before = [round(x, 2) for x in os.getloadavg()]
    spark = local_session(cpus, app="dialstat-bench")

    warm, cold, rows, errors = {}, {}, {}, {}
    for name, (fn, _) in QUERIES.items():
        try:
            cold[name], rows[name] = _time(spark, fn, sf_dir)
        except Exception as err:  # keep timing the others; report the failure
            errors[name] = f"{type(err).__name__}: {str(err)[:200]}"
    for name in cold:
        try:
            warm[name] = min(_time(spark, QUERIES[name][0], sf_dir)[0] for _ in range(repeats))
        except Exception as err:
            errors[name] = f"{type(err).__name__}: {str(err)[:200]}"

    def rounded(names):
        return {q: (round(warm[q], 3) if q in warm else None) for q in names}

    headline = rounded(HEADLINE)
    others = rounded([q for q in QUERIES if q not in HEADLINE])
    sf_name = Path(sf_dir).name
    out = {
        "metric": "sum of best warm seconds over the six report queries",
        "value": None if errors.keys() & set(HEADLINE) else round(sum(headline.values()), 3),
        "unit": "sec",
        "queries": headline,
        "other_queries": others,
        "cold": {q: round(v, 3) for q, v in cold.items()},
        "rows": rows,
        "sf": sf_name[2:] if sf_name.startswith("sf") else sf_name,
        "cpus": cpus,
        "loadavg_before": load_before,  # host load visibly moves these timings
    }
    if errors:
        out["errors"] = errors
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
