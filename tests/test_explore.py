from __future__ import annotations

import numpy as np

from farelane.plans.explore import explore_report, explore_stages
from farelane.sources.derived import trips

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.01"


def test_each_quantile_sees_the_stage_before(spark):
    stages = explore_stages(trips(spark, SF))
    frames = {n: getattr(stages, n).toPandas() for n in ("after_coords", "after_passengers", "after_distance")}
    coords = frames["after_coords"]
    cut = np.nanquantile(coords.passenger_count.astype(float), 0.98)
    kept = coords[~(coords.passenger_count > cut)]
    assert sorted(frames["after_passengers"].key) == sorted(kept.key)
    passengers = frames["after_passengers"]
    cut = passengers.hav_distance_km.quantile(0.99)
    kept = passengers[~(passengers.hav_distance_km > cut)]
    assert sorted(frames["after_distance"].key) == sorted(kept.key)


def test_report_equals_the_single_queries(spark):
    report = explore_report(trips(spark, SF))
    assert len(report) == 12
    for name in ("trips_by_passengers", "invalid_fare_rate", "invalid_coord_rate"):
        expected = entry_module.queries()[name](spark, SF).collect()
        assert [tuple(r) for r in report[name].collect()] == [tuple(r) for r in expected]
    bins = {r.bin: r.n_trips for r in report["distance_histogram_trimmed"].collect()}
    assert sum(bins.values()) == sum(r.n_trips for r in report["trips_by_passengers"].collect()) + _without_passengers(spark)
    assert report["median_fare_by_hour"].count() == 24
    assert report["n_trips_up_to_1_h_before_table"].count() > 1
    assert -1 <= report["n_trips_up_to_30_min_before_corr"].first()[0] <= 1


def _without_passengers(spark):
    return explore_stages(trips(spark, SF)).after_distance.filter("passenger_count IS NULL").count()
