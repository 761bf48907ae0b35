"""Rule columns on parsed transactions, flagged rows and threshold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.geo import distance_km
from tallywatch.functions.rules import exceeds
from tallywatch.schema import DEFAULT_CONFIG, RiskConfig


def apply_rules(df: DataFrame, config: RiskConfig = DEFAULT_CONFIG) -> DataFrame:
    """Adds the distance, the amount and location flags and their OR.

    Window frequency is a separate output and does not enter ``is_flagged``.
    """
    return (
        df.withColumn(
            "distance_from_nairobi",
            distance_km(F.col("latitude"), F.col("longitude"), config),
        )
        .withColumns({
            "is_high_amount": exceeds(F.col("amount"), config.max_amount),
            "is_location_outlier": exceeds(
                F.col("distance_from_nairobi"), config.max_distance_km
            ),
        })
        .withColumn("is_flagged", F.col("is_high_amount") | F.col("is_location_outlier"))
    )


def flagged(df: DataFrame) -> DataFrame:
    return df.filter("is_flagged")


def search(df: DataFrame, **terms) -> DataFrame:
    """Rows whose columns equal every given term."""
    for column, value in terms.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


MAX_RULES = 10_000


def apply_rule_table(
    df: DataFrame, rules: DataFrame, id_columns: list[str], only_fired: bool = False
) -> DataFrame:
    """One row per transaction and rule on one of its measures, or only for fired rules.

    ``rules`` has ``rule_id, measure, threshold``; measures are ``amount`` and
    ``distance_km`` (``df`` must carry ``distance_from_nairobi``). A rule fires strictly
    above its threshold. The rules travel as arrays of about ``MAX_RULES``, so rows are neither
    shuffled nor multiplied before the rules are decided.
    """
    parts = max(1, -(-rules.count() // MAX_RULES))
    part = F.pmod(F.xxhash64("rule_id"), F.lit(parts))
    decided = [
        _decided(df, rules.filter(part == i), id_columns, only_fired) for i in range(parts)
    ]
    return reduce(DataFrame.unionByName, decided)


def _decided(
    df: DataFrame, rules: DataFrame, id_columns: list[str], only_fired: bool
) -> DataFrame:
    listed = rules.agg(
        F.array_sort(F.collect_list(F.struct("rule_id", "measure", "threshold"))).alias("rules")
    ).scalar()

    def decide(rule: Column) -> Column:
        measured = F.when(rule["measure"] == "amount", F.col("amount")).when(
            rule["measure"] == "distance_km", F.col("distance_from_nairobi")
        )
        return F.struct(
            rule["rule_id"].alias("rule_id"),
            F.coalesce(measured > rule["threshold"], F.lit(False)).alias("fired"),
        )

    known = F.filter("_rules", lambda r: r["measure"].isin("amount", "distance_km"))
    decided = F.transform(known, decide)
    if only_fired:
        decided = F.filter(decided, lambda r: r["fired"])
    return df.withColumn("_rules", listed).select(*id_columns, F.inline(decided))
