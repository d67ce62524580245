"""Event-catalogue clean-up: impute every measurement, cap outliers, add time features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.operators.filters import require
from tablewright.operators.learners import forest_impute
from tablewright.operators.missing import fill_cascade, fill_global_median, fill_group_median
from tablewright.operators.neighbours import knn_impute
from tablewright.operators.scaling import winsorise
from tablewright.operators.schema import columns_of
from tablewright.session import cut_lineage

# fixed values: measurements that are coordinates, never capped
COORDINATES = ("latitude", "longitude")


def impute_catalogue(events: DataFrame, legacy_null_key: bool = False, trees: int = 100) -> DataFrame:
    """No missing measurement left: medians per magnitude type, neighbours, a forest, global medians.

    The frame is stored before and after each model-based step, so no step repeats an earlier one.
    """
    where = ["latitude", "longitude", "depth"]
    q = cut_lineage(require(events, "mag"))  # medians read it several times
    q = cut_lineage(fill_group_median(q, "nst", ["magType"], legacy_null_key=legacy_null_key))
    q = cut_lineage(knn_impute(q, "id", [*where, "mag"], "gap"))
    q = cut_lineage(knn_impute(q, "id", where, "dmin"))
    q = cut_lineage(fill_global_median(q, ["rms"]))
    q = cut_lineage(forest_impute(q, [*where, "mag", "rms"], "horizontalError", trees=trees))
    q = fill_global_median(q, ["depthError"])
    q = fill_group_median(q, "magError", ["magType"], legacy_null_key=legacy_null_key)
    return fill_cascade(q, "magNst", ["nst"], ["magType"], legacy_null_key=legacy_null_key)


def cap_catalogue(events: DataFrame, k: float = 3.0) -> DataFrame:
    """Cap every measurement at k population deviations, floor depth at 0, add hour and day name."""
    measures = columns_of(events, "number", exclude=COORDINATES)
    capped = winsorise(events, measures, k, floor_zero=["depth"])
    return capped.withColumn("hour", F.hour("time")).withColumn("day_of_week", F.date_format("time", "EEEE"))


def negative_depths(events: DataFrame) -> DataFrame:
    """How many depths of the uncapped frame the floor concerns."""
    return events.agg(F.count_if(F.col("depth") < 0).alias("floored"))
