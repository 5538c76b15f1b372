"""Row-history windows and ranks that stay parallel inside one long series.

A plain window over (city, metric) sorts each series in one task. Here a series of more than ``block_rows`` rows is cut
into blocks of about so many, and the rows just before a block are handed to it as halo rows. Where blocks and halos
start comes from row counts per slice (a calendar day by default). Only those starts travel: one row for each long
series, at most ``EDGES`` starts in all, broadcast. The rows themselves are shuffled once, to block and halo.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlattice.functions.times import col
from airlattice.tables import lookup

BLOCK_ROWS = 1 << 18
#: Starts of blocks that all series may have together. Blocks grow beyond ``block_rows`` where there would be more.
EDGES = 1 << 13


def block_edges(df: DataFrame, keys: list[str], history: int, block_rows: int, edges: int = EDGES) -> DataFrame:
    """(keys, starts, halos, bases) for each series with more rows than a block, from the ``_slice`` column of ``df``.

    Blocks after the first begin at the slices ``starts``, with ``bases`` rows of the series before them; the last
    ``history`` rows before a block lie in the slices from ``halos`` on. There are at most ``edges`` starts in all.
    """
    counts = df.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    most = F.greatest(F.lit(max(block_rows, history, 1)), F.ceil(counts.agg(F.sum("_n")).scalar() / edges))
    series = Window.partitionBy(*keys)
    forward = series.orderBy("_slice")
    long = counts.withColumn("_most", most).withColumn("_total", F.sum("_n").over(series)).filter("_total > _most")
    sized = (long.withColumn("_before", F.sum("_n").over(forward) - F.col("_n"))
             .withColumn("_block", F.floor(F.col("_before") / F.col("_most")))
             .withColumn("_previous", F.lag("_slice").over(forward)))
    # The first slice with fewer than ``history`` rows before this one, and from it one slice back.
    near = series.orderBy("_before").rangeBetween(-(max(history, 1) - 1), 0)
    opened = (sized.withColumn("_halo", F.first(F.coalesce("_previous", "_slice")).over(near))
              .withColumn("_opens", F.col("_block") > F.lag("_block").over(forward)).filter("_opens"))
    starts = F.array_sort(F.collect_list(F.struct("_slice", "_halo", "_before")))
    return (opened.groupBy(*keys).agg(starts.alias("_starts"))
            .select(*keys, F.col("_starts._slice").alias("_starts"), F.col("_starts._halo").alias("_halos"),
                    F.col("_starts._before").alias("_bases")))


def _reached(ordered: Column, value: Column, edges: int) -> Column:
    """How many entries of an ordered array are not above ``value``, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(edges.bit_length() - 1, -1, -1)])

    def step(found: Column, width: Column) -> Column:
        inside = (found + width <= F.size(ordered)) & (F.get(ordered, found + width - 1) <= value)
        return F.when(inside, found + width).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def in_blocks(df: DataFrame, keys: list[str], slice_by: Column, history: int, block_rows: int = BLOCK_ROWS,
              edges: int = EDGES) -> DataFrame:
    """Every row with its ``_block`` and the ``_base`` rows of the series before it, and again, as ``_halo``, in each later
    block that looks back at it."""
    # A struct is never null and orders a null inside it first, as windows do.
    sliced = df.withColumn("_slice", F.struct(slice_by.alias("s")))
    found = block_edges(sliced, keys, history, block_rows, edges)
    if keys:
        placed = lookup(sliced, F.broadcast(found), keys, "left")
    else:
        one = found.select(F.struct("_starts", "_halos", "_bases").alias("_edges")).scalar()
        placed = (sliced.withColumn("_edges", one)
                  .select(*sliced.columns, *[F.col("_edges").getField(c).alias(c) for c in ("_starts", "_halos", "_bases")]))
    own = F.when(F.col("_starts").isNull(), 0).otherwise(_reached(F.col("_starts"), F.col("_slice"), edges))
    last = F.when(F.col("_starts").isNull(), 0).otherwise(_reached(F.col("_halos"), F.col("_slice"), edges)) if history else F.col("_own")
    base = F.when(F.col("_own") > 0, F.get("_bases", F.col("_own") - 1)).otherwise(0)
    return (placed.withColumn("_own", own).withColumn("_base", base)
            .withColumn("_block", F.explode(F.sequence("_own", F.greatest("_own", last))))
            .withColumn("_halo", F.col("_block") > F.col("_own"))
            .drop("_slice", "_starts", "_halos", "_bases", "_own"))


def position_in_series(df: DataFrame, keys: list[str], order: list, slice_by: Column,
                       name: str = "position", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Zero-based rank of each row within its series.

    ``slice_by`` must never decrease along ``order``: the rank is the number of rows in earlier blocks of slices plus
    the rank within the own block.
    """
    placed = in_blocks(df, keys, slice_by, 0, block_rows)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    return (placed.withColumn(name, F.col("_base") + F.row_number().over(inside) - 1)
            .drop("_block", "_base", "_halo"))


def with_history(df: DataFrame, keys: list[str], order: str, history: int, columns,
                 slice_by: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add window columns that look back at most ``history`` rows of the series.

    ``columns`` maps a name to a function of a window specification, which is ordered
    by ``order`` and partitioned so that at least ``history`` earlier rows are seen.
    """
    placed = in_blocks(df, keys, F.to_date(order) if slice_by is None else slice_by, history, block_rows)
    spec = Window.partitionBy(*keys, "_block").orderBy(order)
    return (placed.withColumns({name: make(spec) for name, make in columns.items()})
            .filter(~F.col("_halo"))
            .drop("_block", "_halo", "_base"))


def lag_of(value, rows: int):
    return lambda spec: F.lag(col(value), rows).over(spec)


def trailing_mean(value, rows: int):
    """Mean of the last ``rows`` rows including the current one; NULLs are left out."""
    return lambda spec: F.avg(col(value)).over(spec.rowsBetween(-(rows - 1), 0))


def lag_features(df: DataFrame, value: str, lags: list[int], by: list[str],
                 ts: str = "timestamp", prefix: str | None = None, **layout) -> DataFrame:
    prefix = prefix or f"{value}_lag_"
    made = {f"{prefix}{k}h": lag_of(value, k) for k in lags}
    return with_history(df, by, ts, max(lags), made, **layout)


def rolling_means(df: DataFrame, value: str, sizes: list[int], by: list[str],
                  ts: str = "timestamp", prefix: str | None = None, **layout) -> DataFrame:
    prefix = prefix or f"{value}_ma_"
    made = {f"{prefix}{n}h": trailing_mean(value, n) for n in sizes}
    return with_history(df, by, ts, max(sizes) - 1, made, **layout)


def trailing_days_mean(df: DataFrame, value: str, days: int, by: list[str],
                       ts: str = "timestamp", name: str = "mean", block_days: int = 64) -> DataFrame:
    """Mean over the ``days`` days up to and including each row's time.

    Blocks are runs of whole days, at least ``days`` long, and a row within ``days`` of the
    next block is its halo. Decimals are summed exactly, so their mean does not depend on order.
    """
    block_days = max(block_days, days)
    second = F.unix_seconds(col(ts).cast("timestamp"))
    span, width = days * 86_400, block_days * 86_400
    own = F.floor(second / width)
    reach = F.floor((second + span - 1) / width)
    placed = (df.withColumn("_second", second)
              .withColumn("_own", own)
              .withColumn("_block", F.explode(F.array_distinct(F.array(own, reach)))))
    spec = (Window.partitionBy(*by, "_block").orderBy("_second").rangeBetween(-(span - 1), 0))
    mean = F.sum(value).over(spec).cast("double") / F.count(value).over(spec)
    return (placed.withColumn(name, mean)
            .filter(F.col("_block") == F.col("_own"))
            .drop("_second", "_own", "_block"))


def fill_hours(df: DataFrame, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Every row, and a row of NULLs for each hour without one from the first to the last of a series."""
    hours = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    days = hours.select(*keys, "_lo", "_hi", F.explode(
        F.sequence(F.date_trunc("day", "_lo"), F.date_trunc("day", "_hi"),
                   F.expr("INTERVAL 1 DAY"))).alias("_day"))
    spine = (days.select(*keys, "_lo", "_hi", F.explode(
                F.transform(F.sequence(F.lit(0), F.lit(23)),
                            lambda h: F.col("_day") + F.make_interval(hours=h))).alias(ts))
             .filter(F.col(ts).between(F.date_trunc("hour", "_lo"), F.col("_hi")))
             .drop("_lo", "_hi"))
    hourly = df.withColumnRenamed(ts, "_at").withColumn(ts, F.date_trunc("hour", "_at"))
    return (lookup(spine, hourly, [*keys, ts], "left")
            .withColumn(ts, F.coalesce("_at", ts)).drop("_at"))


def exact_medians(df: DataFrame, columns: list[str], by: list[str], cells: int = 4096) -> DataFrame:
    """Exact medians as (by, column, median), NULLs and NaNs left out.

    Three passes over the input: a bracket of approximate percentiles around the middle of
    each group, row counts in equal-width cells of the bracket (and below and above it), and
    the rows of just the one or two cells that hold the middle ranks. Outliers lie outside
    the bracket, which holds about a twentieth of the rows; equal values are counted, not sorted.
    """
    keys = [*by, "column"]
    long = (df.select(*by, F.explode(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                for c in columns])).alias("_p"))
            .select(*by, "_p.column", "_p.v").filter("v IS NOT NULL AND NOT isnan(v)"))
    ends = (long.groupBy(*keys).agg(F.percentile_approx("v", [0.48, 0.52], 1000).alias("_b"))
            .select(*keys, F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi")))
    share = F.try_divide(F.col("v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    cell = (F.when(F.col("v") < F.col("_lo"), -1).when(F.col("v") > F.col("_hi"), cells)
            .otherwise(F.coalesce(F.least(F.floor(share * cells), F.lit(cells - 1)), F.lit(0))))
    celled = lookup(long, ends, keys).select(*keys, "v", cell.alias("_cell"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    low_rank, high_rank = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    middle = (celled.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_in_cell"))
              .withColumn("_before", F.coalesce(F.sum("_in_cell").over(earlier), F.lit(0)))
              .withColumn("_total", F.sum("_in_cell").over(whole))
              .filter((F.col("_before") <= high_rank) & (F.col("_before") + F.col("_in_cell") > low_rank))
              .drop("_in_cell"))
    inside = Window.partitionBy(*keys, "_cell").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (lookup(celled, middle, [*keys, "_cell"])
              .groupBy(*keys, "_cell", "_before", "_total", "v").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_from", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))))

    def value_at(rank):
        here = (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_n"))
        return F.max(F.when(here, F.col("v")))

    return ranked.groupBy(*keys).agg(((value_at(low_rank) + value_at(high_rank)) / 2).alias("median"))
