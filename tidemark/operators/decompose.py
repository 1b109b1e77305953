"""Monthly decomposition: centred rolling mean and per-period climatology."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import month_label
from tidemark.functions.values import round_or_null
from tidemark.spec import MIN_DECOMPOSE_DAYS, MIN_DECOMPOSE_MONTHS, PERIODS, ROLLING_MONTHS


def usable_months(
    monthly_long: DataFrame,
    keys: Sequence[str],
    min_days: int = MIN_DECOMPOSE_DAYS,
    min_months: int = MIN_DECOMPOSE_MONTHS,
) -> DataFrame:
    """Months with a value, of series long enough to decompose.

    Observed days count over all months, also over those that end up without a value.
    """
    w = Window.partitionBy(*keys, "variable")
    sized = monthly_long.withColumns(
        {"_days": F.sum("n_obs").over(w), "_months": F.count("value").over(w)}
    )
    enough = (F.col("_days") >= min_days) & (F.col("_months") >= min_months)
    return sized.where(enough & F.col("value").isNotNull()).drop("_days", "_months")


def rolling_centred(
    months: DataFrame, keys: Sequence[str], width: int = ROLLING_MONTHS, value: str = "value"
) -> DataFrame:
    """Add ``trend``, the mean of ``width`` rows around each month.

    Rows, not calendar months: a month without a value is not in the series. An even
    window reaches one row further back than ahead, and is missing until it is full.
    """
    w = (
        Window.partitionBy(*keys, "variable")
        .orderBy("month")
        .rowsBetween(-(width // 2), width - width // 2 - 1)
    )
    full = F.count(value).over(w) == width
    return months.withColumn("trend", F.when(full, F.avg(value).over(w)))


def period_climatology(
    months: DataFrame,
    keys: Sequence[str],
    periods: Sequence[tuple[int, int]] = PERIODS,
    value: str = "value",
) -> DataFrame:
    """Mean and exact 10th and 90th percentile per period and month of the year.

    Only periods in which the series has all twelve months. A group of the
    percentile holds one value per year of its period.
    """
    year, month = F.year("month"), F.month("month")
    listed = [F.when(year.between(a, b), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))) for a, b in periods]
    in_periods = months.select(
        *keys, "variable", month.alias("moy"), value, F.explode(F.array_compact(F.array(*listed))).alias("pd")
    )
    by = [*keys, "variable", F.col("pd.a").alias("period_start"), F.col("pd.b").alias("period_end")]
    stats = in_periods.groupBy(*by, "moy").agg(
        F.avg(value).alias("mean"), F.percentile(value, F.array(F.lit(0.1), F.lit(0.9))).alias("q")
    )
    whole = Window.partitionBy(*keys, "variable", "period_start", "period_end")
    return (
        stats.withColumn("_months", F.count(F.lit(1)).over(whole))
        .where(F.col("_months") == 12)
        .select(
            *keys,
            "variable",
            "period_start",
            "period_end",
            F.col("moy").alias("month"),
            "mean",
            F.col("q")[0].alias("p10"),
            F.col("q")[1].alias("p90"),
        )
    )


def decompose(
    monthly_long: DataFrame,
    keys: Sequence[str],
    periods: Sequence[tuple[int, int]] = PERIODS,
    min_days: int = MIN_DECOMPOSE_DAYS,
    min_months: int = MIN_DECOMPOSE_MONTHS,
) -> DataFrame:
    """One nested row per ``(*keys, variable)``: months, observed, trend, climatology.

    Series without a single complete period are left out. The arrays are as long as
    the calendar of the series.
    """
    months = usable_months(monthly_long, keys, min_days, min_months)
    by = [*keys, "variable"]

    def pick(field: str) -> Column:
        return F.col(f"pts.{field}").alias(field)

    point = F.struct(
        "month",
        month_label(F.col("month")).alias("months"),
        round_or_null(F.col("value")).alias("observed"),
        round_or_null(F.col("trend")).alias("trend"),
    )
    series = (
        rolling_centred(months, keys)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(point)).alias("pts"))
        .select(*by, pick("months"), pick("observed"), pick("trend"))
    )
    cell = F.struct("month", *[round_or_null(F.col(c)).alias(c) for c in ("mean", "p10", "p90")])
    climatology = (
        period_climatology(months, keys, periods)
        .groupBy(*by, "period_start", "period_end")
        .agg(F.sort_array(F.collect_list(cell)).alias("values"))
        .groupBy(*by)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(F.array("period_start", "period_end").alias("period"), "values")
                )
            ).alias("climatology")
        )
    )
    return series.join(climatology, by)
