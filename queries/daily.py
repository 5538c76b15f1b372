"""Reports from stored day profiles, with the fact rows taken away, against the SQL of the reports over facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.operators import quality as Q
from airlattice.operators import stats
from airlattice.plans import daily, reports, views
from airlattice.sources.eventlog import event_warehouse

from queries import quality, relational, reporting  # noqa: F401  their SQL is used again
from queries.base import ORACLES, query
from queries.reporting import WHERE, XS


def from_profiles(name: str, sql_of: str, weather: bool = False):
    """A query whose tables keep no fact rows: profiles are made and stored first, then facts are emptied."""
    def register(make):
        def run(spark, folder):
            t = daily.with_profiles(event_warehouse(spark, folder))
            t = t.but(fact_observation=t.fact_observation.filter("false"))
            return make(t if weather else t.but(fact_weather=t.fact_weather.filter("false")))
        query(name)(run)
        ORACLES[name] = ORACLES[sql_of]
        return make
    return register


from_profiles("A1_daily_aggregates_from_profiles", "A1_v_daily_aggregates", weather=True)(views.v_daily_aggregates)
from_profiles("A2_exceedances_from_profiles", "A2_v_days_with_exceedances")(views.v_days_with_exceedances)
from_profiles("A3_completeness_from_profiles", "A3_v_data_completeness")(views.v_data_completeness)
from_profiles("A5_completeness_range_from_profiles", "A5_completeness_range")(
    lambda t: reports.completeness_range(t, "2024-01-08", "2024-01-21", WHERE["cities"], WHERE["metrics"]))
from_profiles("A8_period_statistics_from_profiles", "A8_period_statistics", weather=True)(
    lambda t: reports.period_statistics(t, **WHERE))
from_profiles("A17_correlations_from_profiles", "A17_correlation_matrix")(
    lambda t: reports.weather_correlations(t, metrics=C.REQUESTED_METRICS))
from_profiles("T4_correlations_in_scope_from_profiles", "T4_correlations_in_scope")(
    lambda t: reports.weather_correlations(t, **WHERE))
from_profiles("A18_ranked_correlations_from_profiles", "A18_ranked_correlations")(
    lambda t: stats.rank_correlations(reports.weather_correlations(t, metrics=C.REQUESTED_METRICS)))
from_profiles("A19_linear_trend_from_profiles", "A19_linear_trend")(lambda t: daily.trends(t, XS))


@query("Q5_zscore_with_moments_from_profiles")
def zscore(spark, folder):
    """The moments come from profiles, so the facts are read once."""
    t = daily.with_profiles(event_warehouse(spark, folder))
    by = ["city_id", "metric_id"]
    return Q.zscore_outliers(t.fact_observation, "value_ug_m3", by=by, moments=daily.moments(t, by))


ORACLES["Q5_zscore_with_moments_from_profiles"] = ORACLES["Q5_zscore_by_series"]


@query("A7_locations_by_merged_sketches")
def locations(spark, folder):
    """Sketches of the days, merged, stay within 6 % of the exact number of places (three standard errors are 5 %)."""
    t = daily.with_profiles(event_warehouse(spark, folder))
    exact = reports.station_metadata(t).select(*reports.PAIR, F.col("unique_locations").alias("exact"))
    empty = t.but(fact_observation=t.fact_observation.filter("false"))
    merged = reports.station_metadata(empty, approximate=True).join(exact, reports.PAIR)
    close = F.abs(F.col("unique_locations") - F.col("exact")) <= 0.06 * F.col("exact")
    return merged.select(*reports.PAIR, "avg_stations", "total_records", close.alias("close"))


ORACLES["A7_locations_by_merged_sketches"] = f"SELECT city_name, metric_code, avg_stations, total_records, TRUE AS close FROM ({ORACLES['A7_station_metadata']})"


# The rows before the range that the first rows of each series look back at are found by the row counts of the days.
for view, whole in (("v_moving_averages", "T2_browse_moving_averages"), ("v_lags", "T2_browse_lags")):
    @query(f"T2_pruned_browse_of_{view}")
    def pruned(spark, folder, view=view):
        return reports.browse(daily.with_profiles(event_warehouse(spark, folder)), view, **WHERE)

    ORACLES[f"T2_pruned_browse_of_{view}"] = f"SELECT * FROM ({ORACLES[whole]}) WHERE {reporting.IN_TIME}"
