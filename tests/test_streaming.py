"""Streams equal batches, drop repeats and write once."""

import json
from datetime import datetime, timedelta

import pytest

from airlattice.plans.load_run import hourly_observations, load_cities, merged_hours, run_load
from airlattice.sources import payloads
from airlattice.streaming import ingest as ST
from airlattice.tables import default_cities, read_table

START = datetime(2024, 6, 1)


@pytest.fixture
def landed(tmp_path):
    """Two days of half-hourly values with repeats, then a late marker that closes all hours."""
    folder = tmp_path / "obs" / "city=Berlin"
    folder.mkdir(parents=True)

    def record(minutes, station, value):
        return json.dumps({"location": {"id": station}, "parameter": "pm25", "value": value, "unit": "µg/m³",
                           "date": {"utc": (START + timedelta(minutes=minutes)).isoformat() + "Z"}})

    lines = [record(m, s, m / 10 + s) for m in range(0, 2 * 1440, 30) for s in (1, 2)]
    (folder / "a.json").write_text("\n".join(lines + lines[:50] + ["{bad"]))
    (folder / "b.json").write_text(record(10 * 1440, 1, 1.0))
    return str(tmp_path / "obs")


def run(spark, landed, root, checkpoint):
    cities = read_table(spark, root, "dim_city")
    ST.stream_to_warehouse(ST.hourly_stream(ST.ingest_stream(spark, landed, cities)), root, checkpoint).awaitTermination()


def test_stream_equals_batch_and_repeats_nothing(spark, landed, tmp_path):
    root = str(tmp_path / "store")
    assert load_cities(spark, root, default_cities(spark)) == 5
    run(spark, landed, root, str(tmp_path / "c1"))
    batch = hourly_observations(payloads.read_observations(spark, landed, default_cities(spark)).dropDuplicates(ST.DUPLICATE_KEY))
    want = {(r["timestamp"], r["value_ug_m3"], r["station_count"]) for r in batch.filter("timestamp < '2024-06-05'").collect()}
    stored = read_table(spark, root, "fact_observation")
    got = [(r["timestamp"], r["value_ug_m3"], r["station_count"]) for r in stored.collect()]
    assert len(got) == 48 and set(got) == want
    assert read_table(spark, root, "fact_data_quality_metrics").count() == 2
    run(spark, landed, root, str(tmp_path / "c1"))
    run(spark, landed, root, str(tmp_path / "c2"))
    assert read_table(spark, root, "fact_observation").count() == 48
    assert read_table(spark, root, "fact_data_quality_metrics").count() == 2


def test_load_run(spark, landed, tmp_path):
    sky = tmp_path / "sky" / "city=Berlin"
    sky.mkdir(parents=True)
    times = [(START + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(60)]
    (sky / "w.json").write_text(json.dumps({"hourly": {"time": times, "temperature_2m": [1.0 * h for h in range(60)]}}))
    root = str(tmp_path / "store")
    first = run_load(spark, root, landed, str(tmp_path / "sky"), default_cities(spark), "2024-06-03")
    assert first["written"] == {"fact_observation": 49, "fact_weather": 60, "fact_data_quality_metrics": 3}
    summary = first["summary"].first()
    assert (summary["cities_processed"], summary["cities_failed"], summary["total_weather_records"]) == (1, 4, 60)
    assert summary["cities_with_issues"] == 1
    again = run_load(spark, root, landed, str(tmp_path / "sky"), default_cities(spark), "2024-06-03")
    assert again["written"] == {"fact_observation": 0, "fact_weather": 0, "fact_data_quality_metrics": 3}
    assert again["merged"].count() > 0 and {r["check"] for r in again["recent"].collect()} >= {"range", "monotonic"}
    merged = merged_hours(payloads.read_observations(spark, landed, default_cities(spark)),
                          payloads.read_weather(spark, str(tmp_path / "sky")))
    assert merged.count() == 61 and merged.filter("pm25 IS NOT NULL AND temperature_c IS NOT NULL").count() == 48


def test_losses_are_counted_by_batch(spark, landed, tmp_path):
    """One broken line, 50 repeats, then rows of an unknown city and late ones in a second batch; a rerun adds nothing."""
    root = str(tmp_path / "store")
    load_cities(spark, root, default_cities(spark))

    def once():
        counter = ST.LossCounter(spark, root)
        spark.streams.addListener(counter)
        run(spark, landed, root, str(tmp_path / "c"))
        counter.finish()
        return {r["problem"]: r["records"] for r in ST.losses(spark, root).collect()}

    assert once() == {"records": 2 * 96 + 52, "unreadable record": 1, "no time": 0, "unreadable time": 0, "unreadable value": 0,
                      "unknown city": 0, "late": 0, "repeats": 50}
    late = json.dumps({"location": {"id": 9}, "parameter": "pm25", "value": 1, "unit": "µg/m³", "date": {"utc": START.isoformat() + "Z"}})
    (tmp_path / "obs" / "city=Berlin" / "c.json").write_text(late + "\n" + late.replace("9", "8", 1) + "\n" + '{"parameter": "pm25"}')
    (tmp_path / "obs" / "city=Atlantis").mkdir()
    (tmp_path / "obs" / "city=Atlantis" / "d.json").write_text(late)
    second = once()
    assert (second["records"], second["late"], second["no time"], second["unknown city"], second["repeats"]) == (248, 2, 1, 1, 50)
    batches = spark.read.parquet(f"{root}/{ST.LOSSES}")
    batches.write.mode("append").parquet(f"{root}/again")
    spark.read.parquet(f"{root}/again").write.mode("append").parquet(f"{root}/{ST.LOSSES}")
    assert {r["problem"]: r["records"] for r in ST.losses(spark, root).collect()} == second
