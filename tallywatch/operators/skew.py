"""Per-key aggregates and joins that stay balanced when some keys are hot.

Key counts are looked at before the rows are moved, so the plan fits the data:

* few keys: their aggregates are broadcast and the rows are not shuffled at all;
* many keys: one window pass over the rows, without the hot keys;
* hot keys: partial aggregation, then a broadcast of at most ``max_hot_keys`` rows, or a
  salted join that cuts each hot key into as many parts as its row count asks for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.session import materialize

KEY_ROWS = "_key_rows"
SALT = "_salt"


@dataclass(frozen=True)
class SkewPolicy:
    """Size limits.

    Aggregates per key are broadcast if there are at most ``broadcast_keys`` keys and at most
    ``broadcast_share`` keys per row. A key is hot above ``hot_rows`` rows and above one ``max_hot_keys``-th of all rows, so
    there are never more than ``max_hot_keys`` hot keys, whatever the table size.
    """

    broadcast_keys: int = 200_000
    hot_rows: int = 100_000
    max_hot_keys: int = 200_000
    broadcast_share: float = 0.25


DEFAULT_POLICY = SkewPolicy()


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Null-safe equi-join that keeps the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(and_, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{k}" for k in keys])


class KeyTable:
    """Sizes, hot keys and aggregates of ``rows`` per key.

    Nothing is computed before it is asked for: one scan of the key columns for the sizes, one
    partial aggregation for the hot keys. The table is stored if it is small enough to
    broadcast, the hot keys always.
    """

    def __init__(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        aggregates: dict[str, Column] | None = None,
        policy: SkewPolicy = DEFAULT_POLICY,
    ):
        self.keys = list(keys)
        self.policy = policy
        self._grouped = rows.groupBy(*self.keys).agg(
            F.count("*").alias(KEY_ROWS),
            *[column.alias(name) for name, column in (aggregates or {}).items()],
        )
        self._rows = rows

    @cached_property
    def _sizes(self) -> tuple[int, int]:
        """Rows and estimated keys."""
        size = self._rows.agg(
            F.count("*").alias("rows"),
            F.approx_count_distinct(F.xxhash64(*self.keys)).alias("keys"),
        ).first()
        return size["rows"], size["keys"]

    @property
    def n_rows(self) -> int:
        return self._sizes[0]

    @property
    def row_limit(self) -> int:
        return max(self.policy.hot_rows, self.n_rows // self.policy.max_hot_keys)

    @cached_property
    def _stored(self) -> tuple[DataFrame, int] | None:
        """The table and its exact size, unless the estimate says it is too large."""
        n_rows, n_keys = self._sizes
        if n_keys > min(self.policy.broadcast_keys, self.policy.broadcast_share * n_rows):
            return None
        table = materialize(self._grouped)
        return table, table.count()

    @property
    def is_small(self) -> bool:
        return self._stored is not None and self._stored[1] <= self.policy.broadcast_keys

    @property
    def n_keys(self) -> int:
        return self._stored[1] if self._stored else self._sizes[1]

    @property
    def table(self) -> DataFrame:
        return self._stored[0] if self._stored else self._grouped

    @cached_property
    def _hot(self) -> tuple[DataFrame, int]:
        hot = self.table.filter(F.col(KEY_ROWS) > self.row_limit)
        if not self._stored:
            hot = materialize(hot)
        return hot, hot.agg(F.coalesce(F.sum(KEY_ROWS), F.lit(0))).first()[0]

    @property
    def has_hot_keys(self) -> bool:
        return self.n_rows > self.row_limit and self._hot[1] > 0

    @property
    def hot(self) -> DataFrame:
        """Table rows of the hot keys: at most ``max_hot_keys``."""
        return self._hot[0]

    @property
    def n_hot_rows(self) -> int:
        return self._hot[1] if self.has_hot_keys else 0

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ordinary and of hot keys."""
        hot = F.broadcast(self.hot.select(*self.keys))
        return (
            join_on(rows, hot, self.keys, "left_anti"),
            join_on(rows, hot, self.keys, "left_semi"),
        )


def with_key_aggregates(
    rows: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Adds the aggregates over all rows of the same key to every row."""
    sizes = KeyTable(rows, keys, aggregates, policy)
    if sizes.is_small:
        return join_on(rows, F.broadcast(sizes.table.drop(KEY_ROWS)), keys)

    def windowed(part: DataFrame) -> DataFrame:
        same_key = Window.partitionBy(*keys)
        return part.select(
            "*", *[column.over(same_key).alias(name) for name, column in aggregates.items()]
        )

    if not sizes.has_hot_keys:
        return windowed(rows)
    ordinary, hot = sizes.split(rows)
    return windowed(ordinary).unionByName(
        join_on(hot, F.broadcast(sizes.hot.drop(KEY_ROWS)), keys)
    )


def attach(
    rows: DataFrame, per_key: DataFrame, n_per_key: int, sizes: KeyTable, row_id: str
) -> DataFrame:
    """Left join ``rows`` to ``per_key``, which has ``n_per_key`` rows, one per key.

    ``sizes`` holds the key counts of ``rows``; ``row_id`` spreads the rows of a hot key.
    """
    keys = sizes.keys
    if n_per_key <= sizes.policy.broadcast_keys:
        return join_on(rows, F.broadcast(per_key), keys)
    if not sizes.has_hot_keys:
        return join_on(rows, per_key, keys)
    parts = F.broadcast(sizes.hot.select(
        *keys, F.ceil(F.col(KEY_ROWS) / F.lit(sizes.row_limit)).cast("int").alias("_parts")
    ))
    part_of_row = F.pmod(F.xxhash64(row_id), F.col("_parts"))
    all_parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    salted_rows = join_on(rows, parts, keys).withColumn(
        SALT, F.coalesce(part_of_row, F.lit(0)).cast("int")
    )
    salted_keys = join_on(per_key, parts, keys).withColumn(SALT, F.explode(all_parts))
    return join_on(
        salted_rows.drop("_parts"), salted_keys.drop("_parts"), [*keys, SALT]
    ).drop(SALT)


def broadcast_if_small(table: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after counting that ``table`` has at most ``max_rows`` rows."""
    small = table.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(table) if small else table
