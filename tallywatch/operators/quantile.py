"""Exact quantile of a column without sorting it or gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to this many values one aggregate buffer is fine.
SMALL_COLUMN = 100_000
# Rank error of the bracketing sketch, as one part in so many.
ACCURACY = 10_000


SKETCH_K = 2048
SKETCH_ERROR = 0.005
"""Size of a stored sketch, and a rank error that it stays below with near certainty; results
do not depend on it, only how far the first scan narrows."""


def column_sketches(df: DataFrame, column: str, by: str) -> DataFrame:
    """(``by``, sketch, n): one mergeable sketch of the column's values per group, such as a day.
    Written once per day, the sketches of a year merge without reading its rows."""
    values = df.select(by, F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    return values.groupBy(by).agg(
        F.kll_sketch_agg_double("v", SKETCH_K).alias("sketch"), F.count("*").alias("n"))


def bracket_from(sketches: DataFrame, q: float) -> tuple[int, float, float] | None:
    """Number of values, and two of them that very likely enclose the ``q``-quantile."""
    low, high = max(0.0, q - SKETCH_ERROR), min(1.0, q + SKETCH_ERROR)
    merged = sketches.agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))
    row = merged.filter("n > 0").select(
        "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name)
               for name, share in (("low", low), ("high", high))],
    ).first()
    return row and (row["n"], row["low"], row["high"])


def exact_quantile(
    df: DataFrame, column: str, q: float, small: int | None = None,
    bracket: tuple[int, float, float] | None = None,
) -> float | None:
    """The ``q``-quantile with linear interpolation between neighbouring ranks.

    Large columns are narrowed in rounds: a sketch brackets the wanted rank, one pass counts
    the rows below, at, between and above the bracket ends, and the next round keeps only the
    region that holds the rank. Heavy ties sit on the ends, so each round divides the
    candidates by about 1,000 and three rounds serve 10**12 rows. ``df`` is scanned twice per
    round and should be stored. Up to ``small`` values (by default
    ``SMALL_COLUMN``) are taken in one step. A ``bracket`` from stored sketches of the same rows
    (``bracket_from``) saves the counting scan and the first round's sketch.
    """
    small = SMALL_COLUMN if small is None else small
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    n = values.count() if bracket is None else bracket[0]
    if n == 0:
        return None
    if n <= small:
        return values.agg(F.percentile("v", F.lit(q))).first()[0]
    position = q * (n - 1)
    rank = int(position)
    low = _value_at(values, n, rank, small, bracket and bracket[1:])
    if position == rank:
        return low
    row = values.agg(
        F.count_if(F.col("v") <= low).alias("up_to"),
        F.min(F.when(F.col("v") > low, F.col("v"))).alias("next"),
    ).first()
    high = low if row["up_to"] > rank + 1 else row["next"]
    return low + (high - low) * (position - rank)


def _value_at(
    values: DataFrame, n: int, rank: int, small: int,
    bracket: tuple[float, float] | None = None,
) -> float:
    """Value at 0-based ``rank`` of the ascending order of ``n`` values. Any ``bracket`` gives the
    right value; a good one saves a scan."""
    v = F.col("v")
    margin = 2.0 / ACCURACY
    while n > small:
        share = rank / (n - 1)
        low, high = bracket or values.agg(F.percentile_approx(
            "v",
            F.array(F.lit(max(0.0, share - margin)), F.lit(min(1.0, share + margin))),
            ACCURACY,
        )).first()[0]
        bracket = None
        regions = [(v < low, None), (v == low, low)]
        if low < high:
            regions += [((v > low) & (v < high), None), (v == high, high)]
        regions += [(v > high, None)]
        counts = values.agg(
            *[F.count_if(region).alias(f"n{i}") for i, (region, _) in enumerate(regions)]
        ).first()
        for (region, value), count in zip(regions, counts):
            if rank < count:
                break
            rank -= count
        if value is not None:
            return value
        values, n = values.filter(region), count
    # halfway between two cumulative shares, so rounding cannot pick a neighbour
    share = (rank + 0.5) / n
    return values.agg(
        F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY v)")
    ).first()[0]
