"""The exploratory cleaning, stage by stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.features import add_features
from farelane.operators.demand import (
    HALF_HOUR,
    HOUR,
    demand_fare_corr,
    demand_fare_table,
    rolling_counts,
)
from farelane.operators.quality import invalid_rate, trim_above, valid_coords, valid_fare, weekdays
from farelane.operators.quantiles import chained_quantiles, exact_quantile
from farelane.operators.stats import histogram, median_by, size_by
from farelane.schema import COORDINATES, LABEL
from farelane.session import save_table

# The quantiles beyond which trips are outliers.
PASSENGER_QUANTILE = 0.98
DISTANCE_QUANTILE = 0.99


def trim_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Rows up to the exact ``q`` quantile of ``column``; a null stays."""
    return trim_above(df, column, exact_quantile(df, column, q))


@dataclass(frozen=True)
class Stages:
    """The trips left after each step; ``after_distance`` is what the charts are drawn from."""

    raw: DataFrame
    after_fare: DataFrame
    after_coords: DataFrame
    after_passengers: DataFrame
    after_distance: DataFrame


def fare_stage(trips: DataFrame) -> DataFrame:
    return trips.filter(valid_fare())


def coords_stage(trips: DataFrame) -> DataFrame:
    after_fare = fare_stage(trips)
    return after_fare.filter(valid_coords(after_fare))


def passengers_stage(trips: DataFrame) -> DataFrame:
    """Features are added here: they are projections, computed only where a stage reads them."""
    trimmed = trim_quantile(coords_stage(trips), "passenger_count", PASSENGER_QUANTILE)
    return add_features(trimmed)


def explore_stages(trips: DataFrame) -> Stages:
    """Fare, coordinates, passenger outliers, distance outliers, in this order: each
    quantile is taken over the rows the steps before it left. Both are found in two passes."""
    featured = add_features(coords_stage(trips))
    passengers, distance = chained_quantiles(
        featured, "passenger_count", PASSENGER_QUANTILE, F.col("hav_distance_km"), DISTANCE_QUANTILE
    )
    after_passengers = trim_above(featured, "passenger_count", passengers)
    return Stages(
        raw=trips,
        after_fare=fare_stage(trips),
        after_coords=coords_stage(trips),
        after_passengers=after_passengers,
        after_distance=trim_above(after_passengers, "hav_distance_km", distance),
    )


def explore_clean(trips: DataFrame) -> DataFrame:
    return explore_stages(trips).after_distance


# The names of the demand columns.
DEMAND_WIDTHS = {
    "n_trips_up_to_30_min_before": HALF_HOUR,
    "n_trips_up_to_1_h_before": HOUR,
}


def explore_report(trips: DataFrame) -> dict[str, DataFrame]:
    """Every table of the exploration by name.

    The cleaned trips are written to the shared folder once, so that the quantile passes
    and the distance run once for all tables rather than once for each.
    """
    stages = explore_stages(trips)
    explored = save_table(stages.after_distance.drop(*COORDINATES), "explored")
    report = {
        "invalid_fare_rate": invalid_rate(stages.raw, valid_fare()),
        "invalid_coord_rate": invalid_rate(stages.after_fare, valid_coords(stages.after_fare)),
        "distance_histogram": histogram(stages.after_passengers, "hav_distance_km"),
        "distance_histogram_trimmed": histogram(explored, "hav_distance_km"),
        "median_fare_by_hour": median_by(weekdays(explored), "hour"),
        "median_fare_by_dow": median_by(explored, "day_of_week"),
        "median_fare_by_passengers": median_by(explored, "passenger_count"),
        "trips_by_passengers": size_by(explored, "passenger_count"),
    }
    # One sweep counts for both widths.
    timed = explored.select("key", "pickup_datetime", LABEL)
    counted = save_table(rolling_counts(timed, DEMAND_WIDTHS), "demand")
    for name in DEMAND_WIDTHS:
        report[f"{name}_corr"] = demand_fare_corr(counted, name)
        report[f"{name}_table"] = demand_fare_table(counted, name)
    return report
