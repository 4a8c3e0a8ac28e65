"""Aggregates that are refreshed from a change feed: sums, counts and value counts that inserts add to and deletes take from."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import KeyedTable

ROWS, TIMES = "rows__", "times__"


@dataclass
class Measures:
    """``sums`` and ``values`` map a result's name to its column. Of a column in ``values`` the number of distinct values, the least and the greatest are kept."""

    sums: dict = field(default_factory=dict)
    values: dict = field(default_factory=dict)


class RefreshedAggregate:
    """Aggregate by ``keys`` kept as mergeable state: for each group its number of rows and for each sum the sum and the number of
    values, and for each group and value how often it occurs. All of it can be taken away again, so deletes are exact.

    Both parts of the state are keyed tables: a refresh reads the changes and the parts of the state whose groups they touch. Sums are decimals, so that
    adding and taking away leaves no trace. An average is a sum over its count; the least value after its last occurrence is deleted is found in the value counts.
    """

    def __init__(self, spark, path, keys, measures, parts=16, sum_type="decimal(38,4)"):
        self.spark, self.keys, self.measures, self.sum_type = spark, list(keys), measures, sum_type
        self.groups = KeyedTable(spark, f"{path}/groups", self.keys, parts)
        self.counts = {n: KeyedTable(spark, f"{path}/values_{n}", [*self.keys, "value"], parts) for n in measures.values}

    def refresh(self, changes, batch, weight="weight"):
        """Add a batch of changes: ``weight`` is 1 for an inserted row, -1 for a deleted one; an update is one of each. Replays change nothing.

        Groups without rows go. A NULL in a key is a group of its own; NULLs count in no sum and no value.
        """
        self._merge(self.groups, self._sums(changes, F.col(weight)), [ROWS, *[c for n in self.measures.sums for c in (n, f"{n}_n")]], ROWS, batch)
        for name, table in self.counts.items():
            column = F.col(f"`{self.measures.values[name]}`")
            seen = changes.where(column.isNotNull()).groupBy(*self.keys, column.alias("value")).agg(F.sum(weight).cast("bigint").alias(TIMES))
            self._merge(table, seen, [TIMES], TIMES, batch)

    def _sums(self, changes, weight):
        totals = [F.sum(weight).cast("bigint").alias(ROWS)]
        for name, column in self.measures.sums.items():
            value = F.col(f"`{column}`").cast(self.sum_type)
            totals += [F.coalesce(F.sum(value * weight.cast("int")), F.lit(0)).cast(self.sum_type).alias(name),
                       F.coalesce(F.sum(F.when(value.isNotNull(), weight)), F.lit(0)).cast("bigint").alias(f"{name}_n")]
        return changes.groupBy(*self.keys).agg(*totals)

    def _merge(self, table, partial, numbers, alive, batch):
        marks = {"feed": batch}
        state = table.state()
        if state["marks"].get("feed", -1) >= batch:
            return
        keys = table.keys

        def add(current, fresh):
            both = current.unionByName(fresh).groupBy(*keys).agg(*[F.sum(c).cast(fresh.schema[c].dataType).alias(c) for c in numbers])
            return both.where(F.col(alive) != 0)

        if state["schema"] is None:
            table.create(partial.where(F.col(alive) != 0), marks)
        else:
            table.rewrite(partial, add, marks)

    def read(self) -> DataFrame:
        """One row for each group: its key, ``n_rows``, for each sum the sum (NULL without values) and ``<name>_n``, for each value column
        ``<name>_distinct``, ``<name>_min`` and ``<name>_max``."""
        out = self.groups.read()
        out = out.select(*self.keys, F.col(ROWS).alias("n_rows"),
                         *[c for n in self.measures.sums for c in (F.when(F.col(f"{n}_n") > 0, F.col(n)).alias(n), F.col(f"{n}_n"))])
        for name, table in self.counts.items():
            found = table.read().groupBy(*self.keys).agg(F.count("*").alias(f"{name}_distinct"), F.min("value").alias(f"{name}_min"), F.max("value").alias(f"{name}_max"))
            found = found.select(*[F.col(k).alias(f"__{k}") for k in self.keys], *[c for c in found.columns if c not in self.keys])
            match = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]
            out = out.join(found, match, "left").drop(*[f"__{k}" for k in self.keys])
            out = out.withColumn(f"{name}_distinct", F.coalesce(f"{name}_distinct", F.lit(0)))
        return out


def weighted(inserted, deleted, weight="weight") -> DataFrame:
    """A change feed from inserted and deleted rows."""
    return inserted.withColumn(weight, F.lit(1)).unionByName(deleted.withColumn(weight, F.lit(-1)))
