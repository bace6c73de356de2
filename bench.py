"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query runs to completion through the ``noop`` sink (full execution, no
collect). With ``BENCH_EVENT_LOG_DIR`` set, Spark's event log is written there
for stage and task times. Every query is run once cold (first run in the JVM: class loading
and code generation included) and once warm; ``value`` is the sum of the warm
runs. Queries on stored snapshots are timed on stores that are landed once
beforehand (``setup``, not in ``value``). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["trajectories", "build_cleansed", "movers", "merge_teams", "visual_rank",
            "team_series", "decode_columnar", "latest_poll_season", "union_seasons"]


def _stored(spark, sf_dir: str) -> tuple[dict, dict]:
    """The operators that read or write stores, on inputs landed once, and the
    seconds that the landing took."""
    from rankflow.plans import queries as q
    from rankflow.plans.cleansed import (
        build_cleansed, poll_table, raw_seasons, read_cleansed, write_cleansed,
    )
    from rankflow.schemas import CLEANSED
    from rankflow.session import shared_dir
    from rankflow.sources.columnar import decode_snapshot, encode_columnar
    from rankflow.sources.readers import read_documents

    took, t0 = {}, time.perf_counter()
    raw = q._land_rankings(spark, sf_dir)
    took["raw"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    store = q._cleansed_store(spark, sf_dir)
    took["store"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    docs = shared_dir(spark, "bench_documents")
    encode_columnar(q._cleansed(spark, sf_dir), ["season"], block_rows=q.FIXTURE_BLOCK_ROWS).select(
        "season", "doc").write.partitionBy("season").text(docs)
    took["documents"] = round(time.perf_counter() - t0, 3)

    def build(spark, sf_dir):
        out = shared_dir(spark, "bench_cleansed")
        write_cleansed(build_cleansed(spark, raw), out, q.NEW_STAMP,
                       seasons=raw_seasons(spark, raw))
        return read_cleansed(spark, out)

    return {"build_cleansed": build,
            "union_seasons": lambda s, _: poll_table(s, store, q.SLICE_POLL, q.SLICE_TYPE),
            "decode_columnar": lambda s, _: decode_snapshot(read_documents(s, docs), CLEANSED)}, took


def _run(q, spark, sf_dir, errors: dict, name: str) -> float | None:
    t0 = time.perf_counter()
    try:
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    except Exception as e:  # noqa: BLE001 - report and keep timing the others
        errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        return None
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from rankflow.plans.queries import QUERIES
    from rankflow.session import get_session

    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir} if event_dir else {}
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra_conf=extra)
    names = sys.argv[1:] or HEADLINE
    errors: dict[str, str] = {}
    stored, setup = _stored(spark, sf_dir)
    timed = {**QUERIES, **stored}
    cold = {name: _run(timed[name], spark, sf_dir, errors, name) for name in names}
    warm = {name: _run(timed[name], spark, sf_dir, errors, name) for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    result = {"metric": "headline_total_wall_warm",
              "value": round(sum(v for v in warm.values() if v is not None), 3),
              "unit": "sec", "queries": warm, "cold": cold,
              "cold_total": round(sum(v for v in cold.values() if v is not None), 3), "sf": sf,
              "setup": setup}
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
