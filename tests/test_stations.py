"""Station search and cover, against brute force."""

import math
import random

import pytest

from airlattice.operators import stations as S


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("radius", [25_000, 40_000, 3_000_000, 30_000_000])
def test_radius_join_everywhere(spark, radius):
    """Also at the date line, on the equator, at high latitude and around the pole."""
    rng = random.Random(7)
    cities = {"line": (10.0, 179.99), "west": (-10.0, -179.99), "origin": (0.0, 0.0), "north": (78.2, 15.6),
              "pole": (89.95, 40.0), "edge": (90.0, 0.0), "south": (-89.99, -120.0)}
    stations = []
    for lat, lon in cities.values():
        for _ in range(80):
            y = max(-90.0, min(90.0, lat + rng.uniform(-0.4, 0.4)))
            x = lon + rng.uniform(-0.4, 0.4) / max(math.cos(math.radians(lat)), 0.002)
            stations.append((len(stations), y, (x + 180) % 360 - 180))
    want = {(c, s[0]) for c, at in cities.items() for s in stations if metres(at, s[1:]) <= radius}
    found = S.stations_near(
        spark.createDataFrame([(c, *at) for c, at in cities.items()], "city_name STRING, latitude DOUBLE, longitude DOUBLE"),
        spark.createDataFrame(stations, "location_id BIGINT, latitude DOUBLE, longitude DOUBLE"), radius)
    got = [(r["city_name"], r["location_id"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len({c for c, _ in want}) == len(cities)


def test_nearest_k(spark):
    cities = spark.createDataFrame([("c", 0.0, 0.0)], "city_name STRING, latitude DOUBLE, longitude DOUBLE")
    stations = spark.createDataFrame([(i, 0.001 * i, 0.0) for i in range(9, -1, -1)], "location_id INT, latitude DOUBLE, longitude DOUBLE")
    assert sorted((r["rank"], r["location_id"]) for r in S.stations_near(cities, stations, k=3).collect()) == [(1, 0), (2, 1), (3, 2)]


WANTED = ["pm25", "pm10", "no2", "o3"]


def choose(locations):
    """The fixed-order greedy choice over {id: set} in rank order."""
    for key, has in locations.items():
        if has >= set(WANTED):
            return [key], set()
    left, picked = set(WANTED), []
    for key, has in sorted(locations.items(), key=lambda kv: -len(kv[1] & set(WANTED))):
        if has & left:
            picked.append(key)
            left -= has
    return picked, left


@pytest.mark.parametrize("seed", range(4))
def test_selection(spark, seed):
    rng = random.Random(seed)
    cities = {}
    for c in range(25):
        cities[f"c{c}"] = {f"s{i:02d}": set(rng.sample(WANTED + ["co"], rng.randint(1, 3))) for i in range(rng.randint(1, 12))}
    rows = [(c, s, i, p) for c, locs in cities.items() for i, (s, ps) in enumerate(locs.items()) for p in ps]
    coverage = S.location_coverage(spark.createDataFrame(rows, "city_name STRING, location_id STRING, rank INT, parameter STRING"))
    got, missing = {}, {}
    for r in S.select_stations(coverage).orderBy("city_name", "position").collect():
        got.setdefault(r["city_name"], []).append(r["location_id"])
        missing[r["city_name"]] = set(r["missing"])
    for c, locs in cities.items():
        picked, left = choose({k: v & set(WANTED) for k, v in locs.items() if v & set(WANTED)})
        assert got.get(c, []) == picked and missing.get(c, set(WANTED)) == left


def test_fill_coverage(spark):
    near = spark.createDataFrame([("c", "a", 1, "pm25"), ("d", "a", 1, "pm25"), ("d", "a", 1, "pm10"), ("d", "a", 1, "no2"), ("d", "a", 1, "o3")],
                                 "city_name STRING, location_id STRING, rank INT, parameter STRING")
    far = near.union(spark.createDataFrame(
        [("c", "b", 2, "pm25"), ("c", "x", 3, "o3"), ("c", "y", 4, "o3"), ("c", "y", 4, "no2"), ("e", "z", 1, "o3")], near.schema))
    got = S.fill_coverage(S.location_coverage(near), S.location_coverage(far))
    assert sorted((r["city_name"], r["location_id"], tuple(r["parameters"])) for r in got.collect()) == [
        ("c", "a", ("pm25",)), ("c", "x", ("o3",)), ("c", "y", ("no2",)), ("d", "a", ("no2", "o3", "pm10", "pm25")), ("e", "z", ("o3",))]
    lacking = {r["city_name"]: (r["found"], r["missing"]) for r in S.city_coverage(got).collect()}
    assert lacking["c"] == (["no2", "o3", "pm25"], ["pm10"])
