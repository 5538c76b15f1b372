"""Readers for landed payload files: observations, stations and weather.

Observation fields come in several shapes (text or object). Each record is parsed once
against a fixed layout in which such fields are text, so an object arrives as its own
JSON text and is opened only where that happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.times import naive_in_zone, normalize_timestamp
from airlattice.functions.values import known_unit, to_ug_m3
from airlattice.tables import lookup

ENVELOPE = ("results", "data")
PLACE = ("id: STRING, locationId: STRING, name: STRING, locationName: STRING, latitude: STRING, longitude: STRING, "
         "coordinates: STRUCT<latitude: STRING, longitude: STRING>, "
         "geometry: STRUCT<type: STRING, coordinates: ARRAY<STRING>>")
OBSERVATION = (f"STRUCT<location: STRUCT<{PLACE}>, {PLACE}, parameter: STRING, value: STRING, unit: STRING, "
               "datetime: STRING, date: STRING, dateUTC: STRING, _broken: STRING>")
UNKNOWN_CITY = "unknown city"
#: Why a record is not usable, in the order in which the reasons are looked for.
PROBLEMS = ("unreadable record", "no time", "unreadable time", "unreadable value", UNKNOWN_CITY)
STATION = ("id BIGINT, name STRING, coordinates STRUCT<latitude: DOUBLE, longitude: DOUBLE>, "
           "sensors ARRAY<STRUCT<id: BIGINT, parameter: STRUCT<id: BIGINT, name: STRING, units: STRING>>>")


def read_lines(spark: SparkSession, path: str, whole_files: bool = False, stream: bool = False, **options) -> DataFrame:
    """Payload text, one record or envelope per line (or per file).

    Folders named ``city=...`` give a ``city`` column.
    """
    reader = (spark.readStream if stream else spark.read).options(**options)
    return reader.option("wholetext", whole_files).text(path).filter(F.trim("value") != "")


def unwrap(df: DataFrame, fields=ENVELOPE, text: str = "value") -> DataFrame:
    """One row per record of an envelope: a named list, or a bare list, else nothing."""
    keyed = F.from_json(text, ", ".join(f"{f} ARRAY<STRING>" for f in fields))
    bare = F.from_json(text, "ARRAY<STRING>")
    is_list = F.ltrim(F.col(text)).startswith("[")
    records = F.when(is_list, bare).otherwise(F.coalesce(*[keyed[f] for f in fields]))
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(records).alias("record"))


def as_records(df: DataFrame, text: str = "value") -> DataFrame:
    """Lines that are one record each."""
    return df.withColumnRenamed(text, "record")


def _opened(records: DataFrame, layout: str) -> DataFrame:
    """Each record parsed as column ``r``.

    The parse sits in a generator, which filters are not pushed through: later filters on
    its fields never parse the text a second time.
    """
    parsed = F.from_json("record", layout, {"columnNameOfCorruptRecord": "_broken"})
    return records.select("*", F.explode(F.array(parsed)).alias("r"))


def _object(field: str) -> Column:
    return F.ltrim(F.col(f"r.{field}")).startswith("{")


def _text_or(field: str, *names: str) -> Column:
    """Text of a field, or of the first of ``names`` inside it when it is an object."""
    inside = F.coalesce(*[F.get_json_object(f"r.{field}", f"$.{n}") for n in names])
    return F.when(_object(field), inside).otherwise(F.col(f"r.{field}"))


def _coordinate(name: str, geojson_index: int) -> Column:
    """A coordinate from the location, its fields or its point, else from the record itself."""
    options = []
    for base in ("r.location", "r"):
        point = F.get(F.col(f"{base}.geometry.coordinates"), F.lit(geojson_index))
        options += [F.col(f"{base}.coordinates.{name}"), F.col(f"{base}.{name}"),
                    F.when(F.col(f"{base}.geometry.type") == "Point", point)]
    return F.coalesce(*options).try_cast("double")


def _first_of(*fields: str) -> Column:
    return F.coalesce(*[F.col(f"r.{base}{f}") for base in ("location.", "") for f in fields])


def _value() -> Column:
    """The number of a record. An absent value counts as 0, an explicit null as unreadable."""
    absent = ~F.array_contains(F.json_object_keys("record"), "value")
    number = _text_or("value", "value").try_cast("double")
    empty_object = _object("value") & F.get_json_object("r.value", "$.value").isNull()
    return (F.when(F.col("r.value").isNull(), F.when(absent, 0.0)).when(empty_object, 0.0).otherwise(number))


def classify_observations(records: DataFrame) -> DataFrame:
    """Every record as a flat row with a ``problem`` (NULL when usable)."""
    rest = [c for c in records.columns if c != "record"]
    when = F.coalesce(_text_or("datetime", "utc"), _text_or("date", "utc"), F.col("r.dateUTC"))
    fields = F.struct(
        _first_of("id", "locationId").alias("location_id"),
        _first_of("name", "locationName").alias("location_name"),
        F.lower(F.coalesce(_text_or("parameter", "name", "id"), F.lit(""))).alias("parameter"),
        _value().alias("value"),
        F.lower(F.coalesce(_text_or("unit", "name", "symbol"), F.lit(""))).alias("unit"),
        _coordinate("latitude", 1).alias("latitude"), _coordinate("longitude", 0).alias("longitude"),
        when.alias("_time"), normalize_timestamp(when).alias("timestamp"),
        (F.col("r").isNull() | F.col("r._broken").isNotNull()).alias("_unreadable"))
    # A generator again: later filters and projections read each field, not its expression.
    flat = _opened(records, OBSERVATION).select(*rest, F.inline(F.array(fields)))
    problem = (F.when(F.col("_unreadable"), PROBLEMS[0])
               .when(F.col("_time").isNull(), PROBLEMS[1])
               .when(F.col("timestamp").isNull(), PROBLEMS[2])
               .when(F.col("value").isNull(), PROBLEMS[3]))
    return flat.withColumn("problem", problem).drop("_time", "_unreadable")


def city_places(cities: DataFrame) -> DataFrame:
    """One row per city name in any letter case, the one with the smallest id: (_name, place)."""
    fields = [c for c in ("city_id", "city_name", "country", "timezone", "latitude", "longitude") if c in cities.columns]
    first = "city_id" if "city_id" in cities.columns else "city_name"
    return cities.groupBy(F.lower("city_name").alias("_name")).agg(F.min_by(F.struct(*fields), first).alias("_place"))


def judged(records: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """``classify_observations`` with, where ``cities`` are given, their ``_place``; a record of another city is a problem too."""
    rows = classify_observations(records)
    if cities is None:
        return rows
    return (rows.withColumn("_name", F.lower("city")).join(city_places(cities), "_name", "left").drop("_name")
            .withColumn("problem", F.coalesce("problem", F.when(F.col("_place").isNull(), UNKNOWN_CITY))))


def rejected(records: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """(problem, records) for records that are not usable; with ``cities`` also those of unknown ones."""
    return (judged(records, cities).filter(F.col("problem").isNotNull())
            .groupBy("problem").agg(F.count(F.lit(1)).alias("records")))


def parse_observations(records: DataFrame, cities: DataFrame | None = None, observed: str | None = None) -> DataFrame:
    """Usable records as the long frame, values in micrograms per cubic metre.

    With ``cities`` (and a ``city`` column on the records) the name is matched in any letter
    case and replaced by the stored one, missing coordinates fall back to the city's, and its
    id, country and local wall clock are added. ``rejected`` counts records of unknown cities. ``observed`` names
    metrics that count records and problems while the frame is used, in a stream as well.
    """
    rows = judged(records, cities)
    if observed is not None:
        rows = rows.observe(observed, F.count(F.lit(1)).alias("records"), *[
            F.count_if(F.col("problem") == p).alias(p.replace(" ", "_")) for p in PROBLEMS])
    long = (rows.filter(F.col("problem").isNull()).drop("problem")
            .withColumn("value_ug_m3", to_ug_m3("value", "unit"))
            .withColumn("unit_known", known_unit("unit")))
    if cities is None:
        return long
    added = {"city": F.col("_place.city_name"), "country": F.col("_place.country"),
             "latitude": F.coalesce("latitude", "_place.latitude"), "longitude": F.coalesce("longitude", "_place.longitude"),
             "local_time": F.from_utc_timestamp("timestamp", F.col("_place.timezone"))}
    if "city_id" in cities.columns:
        added["city_id"] = F.col("_place.city_id")
    return long.withColumns(added).drop("_place")


def read_observations(spark: SparkSession, path: str, cities: DataFrame | None = None,
                      envelope: bool = False, whole_files: bool = False) -> DataFrame:
    """Observation payload files as the long frame."""
    lines = read_lines(spark, path, whole_files)
    return parse_observations(unwrap(lines) if envelope else as_records(lines), cities)


def parse_weather(lines: DataFrame, mapping: dict[str, str] | None = None, text: str = "value",
                  source_zone: str | Column = "UTC") -> DataFrame:
    """One row per hour of a payload of parallel arrays; absent parameters are NULL.

    Ragged arrays are padded with NULL. Rows without a readable time are dropped.
    """
    mapping = mapping or C.WEATHER_MAPPING
    arrays = ", ".join(["time ARRAY<STRING>", *[f"{p} ARRAY<DOUBLE>" for p in mapping]])
    hourly = F.from_json(text, f"hourly STRUCT<{arrays}>")["hourly"]
    rest = [c for c in lines.columns if c != text]
    opened = lines.select(*rest, hourly.alias("_h"))
    zipped = F.arrays_zip(F.col("_h.time").alias("time"), *[
        F.coalesce(F.col(f"_h.{p}"), F.array().cast("array<double>")).alias(name)
        for p, name in mapping.items()])
    rows = opened.select(*rest, F.explode(zipped).alias("_row"))
    return (rows.select(*rest, naive_in_zone(F.col("_row.time"), source_zone).alias("timestamp"),
                        *[F.col(f"_row.{n}").alias(n) for n in mapping.values()])
            .filter(F.col("timestamp").isNotNull()))


def read_weather(spark: SparkSession, path: str, mapping: dict[str, str] | None = None,
                 source_zone: str | Column = "UTC", whole_files: bool = False) -> DataFrame:
    """Weather or forecast payload files; pass ``AIR_FORECAST_MAPPING`` for pollutant forecasts."""
    return parse_weather(read_lines(spark, path, whole_files), mapping, source_zone=source_zone)


def parse_stations(records: DataFrame) -> DataFrame:
    """One row per station and sensor from station metadata; stations without id are dropped."""
    rest = [c for c in records.columns if c != "record"]
    station = _opened(records, STATION).filter("r.id IS NOT NULL")
    return (station.select(*rest, F.col("r.id").cast("string").alias("location_id"),
                           F.col("r.name").alias("location_name"),
                           F.col("r.coordinates.latitude").alias("latitude"),
                           F.col("r.coordinates.longitude").alias("longitude"),
                           F.explode_outer("r.sensors").alias("x"))
            .select("*", F.col("x.id").alias("sensor_id"),
                    F.lower(F.coalesce("x.parameter.name", F.lit(""))).alias("parameter"),
                    F.coalesce("x.parameter.units", F.lit("")).alias("unit")).drop("x"))


def read_stations(spark: SparkSession, path: str, envelope: bool = False, whole_files: bool = False) -> DataFrame:
    lines = read_lines(spark, path, whole_files)
    return parse_stations(unwrap(lines) if envelope else as_records(lines))


def attach_sensor_metadata(values: DataFrame, sensors: DataFrame, parameter: str | None = None) -> DataFrame:
    """Latest-value rows with the parameter and unit of their sensor.

    Values of unknown sensors have no parameter and are dropped; coordinates fall back to
    the station's.
    """
    known = sensors.select("location_id", "sensor_id", "parameter", "unit", "location_name",
                           F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    drop = [c for c in ("parameter", "unit", "location_name") if c in values.columns]
    out = lookup(values.drop(*drop), known, ["location_id", "sensor_id"], "left")
    out = out.filter(F.coalesce("parameter", F.lit("")) != "")
    if parameter is not None:
        out = out.filter(F.col("parameter") == parameter.lower())
    return (out.withColumn("latitude", F.coalesce("latitude", "_lat"))
            .withColumn("longitude", F.coalesce("longitude", "_lon")).drop("_lat", "_lon"))


def list_cities(records: DataFrame) -> DataFrame:
    """Distinct city names of city records, blank ones removed."""
    name = F.coalesce(F.nullif("r.name", F.lit("")), "r.city")
    return (_opened(records, "name STRING, city STRING").select(name.alias("city_name"))
            .filter("city_name <> ''").distinct())
