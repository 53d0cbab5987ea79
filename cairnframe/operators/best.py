"""The best measurement of an object: a lexicographic arg-best, on nested arrays without a shuffle or on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import observed_micros

#: Priority of measurements that nobody should use while there are others.
REJECTED = 5


def measurement_priority(source: Column, status: Column) -> Column:
    """0 own and verified, 1 TPN, 2 own, 3 PIG, 4 others, 5 rejected; a null status is not rejected."""
    own, state = F.coalesce(source, F.lit("")), F.coalesce(status, F.lit(""))
    return (
        F.when((own == "wlasne") & (state == "zweryfikowany"), 0)
        .when(state == "odrzucony", REJECTED)
        .when(own == "TPN", 1)
        .when(own == "wlasne", 2)
        .when(own == "PIG", 3)
        .otherwise(4)
    )


def rank_key(m: Column) -> Column:
    """What sorts the best measurement first: priority, latest observation, accuracy, id."""
    return F.struct(
        measurement_priority(m["source"], m["verification_status"]).alias("priority"),
        (-1 - observed_micros(m["observed_at"], m["observed_date"])).alias("age"),
        F.coalesce(m["horizontal_accuracy_m"].cast("double"), F.lit(float("inf"))).alias("accuracy"),
        m["id"].alias("id"),
    )


def best_measurement_id(measurements: Column) -> Column:
    """The id of the best element of an array of measurements; null if none has an id. Stays in the row."""
    ranked = F.transform(F.filter(measurements, lambda m: m["id"].isNotNull()), rank_key)
    return F.get(F.array_sort(ranked), 0)["id"]


def only_rejected(measurements: Column) -> Column:
    """True if there are measurements and all are rejected."""
    return (F.size(measurements) > 0) & F.forall(measurements, lambda m: measurement_priority(m["source"], m["verification_status"]) == REJECTED)


def declared_measurement(measurements: Column, best_id: Column) -> Column:
    """The first measurement with the declared id, or null."""
    return F.get(F.filter(measurements, lambda m: m["id"] == best_id), 0)


def candidate_measurement(measurements: Column, best_id: Column) -> Column:
    """The declared best, else the first."""
    return F.coalesce(declared_measurement(measurements, best_id), F.get(measurements, 0))


def best_per_key(rows: DataFrame, keys: list[str], order: list[Column], value: str, alias: str) -> DataFrame:
    """The `value` of the least row by `order` of each key: one aggregation with partial results, no window."""
    return rows.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)))).alias(alias))
