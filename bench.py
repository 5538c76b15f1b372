"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query runs once to
warm up and then BENCH_RUNS times; the median is reported. With BENCH_DUCKDB=1 the SQL
forms are timed on DuckDB beside them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airlattice.session import build_session  # noqa: E402
from queries import ORACLES, QUERIES  # noqa: E402

HEADLINE = [
    "P1_v_observations", "J2_v_observations_weather", "A1_v_daily_aggregates", "W1_v_moving_averages",
    "W2_v_lags", "E1_v_risk_map", "E2_exceedance_days", "E3_risk_counts", "A3_v_data_completeness",
    "A5_completeness_range", "A8_period_statistics", "A17_correlation_matrix", "A19_linear_trend", "T1_trends",
    "J7_merge_observations_and_weather", "J10_records_by_city", "J11_stations_near", "A22_select_stations",
    "Q5_zscore_by_series", "Q7_quality_report", "Q9_daily_quality_metrics", "S1_observation_payloads",
    "S2_weather_payloads", "S7_latest_per_series", "S13_new_observations", "S20_inject_gap_profile",
    "A10_hourly_by_city", "M1_training_frame", "M4_features", "M10_backtest_overall",
]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def run_once(spark, folder: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def stored_layout(spark, folder: str) -> dict[str, float]:
    """Seconds over facts stored by day with their profiles: pruning, clustering and merged profiles, not the event log."""
    from airlattice.plans import daily, reports, views
    from airlattice.sources.eventlog import event_warehouse
    from airlattice.tables import create_tables, write_table
    root, t = tempfile.mkdtemp(prefix="bench-"), event_warehouse(spark, folder)
    create_tables(spark, root)
    write_table(t.dim_city, root, "dim_city")
    for name in ("fact_observation", "fact_weather"):
        write_table(getattr(t, name), root, name)
    daily.refresh_profiles(spark, root, t.fact_observation, t.fact_weather)
    s = daily.load_profiled(spark, root)
    week = {"start": "2024-01-20", "end": "2024-01-26"}
    runs = {"P1": lambda: views.v_observations(s), "W1": lambda: views.v_moving_averages(s), "W2": lambda: views.v_lags(s),
            "T2_lags_week": lambda: reports.browse(s, "v_lags", **week), "T1_week": lambda: reports.trends(s, **week),
            "A1": lambda: views.v_daily_aggregates(s), "A3": lambda: views.v_data_completeness(s), "A8": lambda: reports.period_statistics(s, **week),
            "A17": lambda: reports.weather_correlations(s), "A19": lambda: daily.trends(s, ["temperature_c", "wind_speed_ms"])}
    out = {}
    for name, make in runs.items():
        for _ in range(2):
            began = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - began, 3)
    return out


def duckdb_seconds(folder: str) -> dict[str, float]:
    import duckdb
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    out = {}
    for name in HEADLINE:
        began = time.perf_counter()
        con.execute(ORACLES[name]).fetchall()
        out[name] = round(time.perf_counter() - began, 4)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"), "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.sql.dataFrameQueryContext.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run_once(spark, folder, name)
        seconds[name] = round(statistics.median(run_once(spark, folder, name) for _ in range(runs)), 3)
    result = {"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
              "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}
    result["stored_layout"] = stored_layout(spark, folder)
    if os.environ.get("BENCH_DUCKDB") == "1":
        result["duckdb"] = duckdb_seconds(folder)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
