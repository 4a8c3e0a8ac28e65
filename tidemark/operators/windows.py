"""Rankings, running frames, sorting and top-k.

Order keys are column names; a leading ``-`` means descending. A ranking is a plain window, unless the caller asks for
``split`` because a group may be larger than one task should sort. Then rows are range-partitioned on (group, order, hash of
the row), ranked inside each range, and shifted by the counts of the ranges before theirs. The hash splits rows that tie in
the order; only rows equal in every column must share a range. A ranking over all rows is always split.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

# Rows of a block, about, in which a running frame is computed.
RANGE_ROWS = 2_000_000


def sort_keys(order):
    return [F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in order]


def _names(order):
    return [o.lstrip("-") for o in order]


def _ntile(position, total, tiles):
    """Tile of a 1-based position: the first ``total % tiles`` tiles hold one row more."""
    size, extra = F.floor(total / tiles), total % tiles
    wide = (size + 1) * extra
    late = F.floor((position - 1 - wide) / F.greatest(size, F.lit(1))) + extra + 1
    return F.when(position <= wide, F.floor((position - 1) / (size + 1)) + 1).otherwise(late)


def rank_rows(df, part, order, tiebreak=(), tiles=2, split=None, **names) -> DataFrame:
    """Add ``alias=kind`` ranking columns; kinds: row_number, rank, dense_rank, ntile.

    ``rank`` and ``dense_rank`` use ``order``; ``row_number`` and ``ntile`` also use ``tiebreak``,
    which should make the order total. ``part`` may be empty for a ranking over all rows. ``split`` is True or a number of
    ranges where groups may be too large for a task; both forms give the same result.
    """
    part, order, full = list(part), list(order), [*order, *tiebreak]
    split = True if split is None and not part else split
    if not split:
        return _rank_plainly(df, part, order, full, tiles, names)
    return _rank_in_ranges(df, part, order, full, tiles, None if split is True else int(split), names)


def _rank_plainly(df, part, order, full, tiles, names):
    group = Window.partitionBy(*part)
    by_rank, by_row = group.orderBy(*sort_keys(order)), group.orderBy(*sort_keys(full))
    kinds = {"row_number": lambda: F.row_number().over(by_row), "rank": lambda: F.rank().over(by_rank),
             "dense_rank": lambda: F.dense_rank().over(by_rank), "ntile": lambda: F.ntile(tiles).over(by_row)}
    return df.select("*", *[kinds[k]().cast("long").alias(a) for a, k in names.items()])


def place_in_ranges(df, part, full, ranges) -> DataFrame:
    """Rows with the number of their range, written once so that both uses see the same.

    Without a number of ranges it follows from the data: adaptive execution merges ranges that the shuffle's statistics show to be small.
    """
    salt = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *sort_keys([*part, *full]), salt)
    return settle(dealt.withColumn("__range", F.spark_partition_id()), "ranges")


def _rank_in_ranges(df, part, order, full, tiles, ranges, names):
    placed = place_in_ranges(df, part, full, ranges)
    if len(placed.inputFiles()) < 2:  # all rows lie in one range
        return _rank_plainly(placed.drop("__range"), part, order, full, tiles, names)
    cell = Window.partitionBy("__range", *part)
    by_rank, by_row = cell.orderBy(*sort_keys(order)), cell.orderBy(*sort_keys(full))
    local = placed.select("*", F.row_number().over(by_row).alias("__row"), F.rank().over(by_rank).alias("__rank"),
                          F.dense_rank().over(by_rank).alias("__dense"), F.count("*").over(cell).alias("__size"))
    value = F.struct(*[F.col(c) for c in _names(order)])
    cells = local.groupBy("__range", *part).agg(
        F.max("__row").alias("__n"), F.max("__dense").alias("__d"), F.max("__rank").alias("__last_rank"),
        F.min_by(value, "__row").alias("__first"), F.max_by(value, "__row").alias("__last"))
    shifts = _range_shifts(cells, part)
    keys = ["__range", *part]
    joined = local.alias("r").join(
        shifts.alias("s"),
        on=[F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], how="left")
    before = F.coalesce(F.col("__rows_before"), F.lit(0))
    tied = F.coalesce(F.col("__tied"), F.lit(0))
    position = before + F.col("__row")
    kinds = {
        "row_number": position,
        "rank": F.when((tied == 1) & (F.col("__dense") == 1), F.col("__carried")).otherwise(before + F.col("__rank")),
        "dense_rank": F.coalesce(F.col("__dense_before"), F.lit(0)) + F.col("__dense") - tied,
        "ntile": _ntile(position, F.coalesce(F.col("__total"), F.col("__size")), tiles),
    }
    return joined.select(*[F.col(f"r.{c}") for c in df.columns],
                         *[kinds[k].cast("long").alias(a) for a, k in names.items()])


def _range_shifts(cells, part):
    """Shifts for groups lying in several ranges.

    Only a group that crosses a range border has more than one cell, and each border is crossed
    by at most one group, so this table has fewer than twice as many rows as there are ranges.
    """
    group = Window.partitionBy(*part)
    ordered = group.orderBy("__range")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    spanning = (cells.withColumn("__cells", F.count("*").over(group)).filter("__cells > 1") if part else cells)
    tied = F.coalesce(F.lag("__last").over(ordered).eqNullSafe(F.col("__first")), F.lit(False))
    has_previous = F.lag("__range").over(ordered).isNotNull()
    spanning = spanning.select(
        "*", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__rows_before"),
        F.sum("__n").over(group).alias("__total"),
        F.when(has_previous & tied, 1).otherwise(0).alias("__tied"))
    start = F.when((F.col("__d") > 1) | (F.col("__tied") == 0), F.col("__rows_before") + F.col("__last_rank"))
    return spanning.withColumn("__start", start).select(
        "__range", *part, "__rows_before", "__total", "__tied",
        F.coalesce(F.sum(F.col("__d") - F.col("__tied")).over(earlier), F.lit(0)).alias("__dense_before"),
        F.last("__start", ignorenulls=True).over(earlier).alias("__carried"))


def rank_groups(df, keys, measure, part, name="rank", alias="total", split=None, **aggs) -> DataFrame:
    """Aggregate by ``keys``, then rank groups inside ``part`` by the measure, highest first."""
    grouped = df.groupBy(*keys).agg(measure.alias(alias), *[a.alias(n) for n, a in aggs.items()])
    return rank_rows(grouped, part, [f"-{alias}"], split=split, **{name: "rank"})


def moving_avg(df, part, order, col, n, name="moving_avg", split=None, block=RANGE_ROWS) -> DataFrame:
    """Average over the current row and the ``n - 1`` before it, in a total order.

    With ``split`` groups are cut into blocks of at least ``n`` rows, and the last ``n - 1`` rows of a block also visit the next.
    """
    part, frame = list(part), (-(n - 1), 0)
    if not split and part:
        window = Window.partitionBy(*part).orderBy(*sort_keys(order)).rowsBetween(*frame)
        return df.withColumn(name, F.avg(col).over(window))
    block = max(block, n)
    numbered = rank_rows(df, part, order, split=split or True, __pos="row_number")
    offset = F.col("__pos") - 1
    home = F.floor(offset / block)
    visits = F.when(offset % block >= block - (n - 1), F.array(home, home + 1)).otherwise(F.array(home))
    spread = numbered.withColumn("__home", home).withColumn("__block", F.explode(visits))
    window = Window.partitionBy("__block", *part).orderBy("__pos").rowsBetween(*frame)
    return (spread.withColumn(name, F.avg(col).over(window)).filter("__block = __home")
            .drop("__pos", "__home", "__block"))


def sequence(df, order, name="seq", split=True) -> DataFrame:
    """Dense 1..n numbering in the given total order."""
    return rank_rows(df, [], order, split=split, **{name: "row_number"})


def arbitrary_sequence(df, name="seq") -> DataFrame:
    """Dense 1..n numbering in no particular order.

    Each partition numbers its own rows; only the row count per partition is gathered.
    """
    placed = settle(df.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    chunk = F.shiftright("__id", 33)
    counts = placed.groupBy(chunk.alias("__chunk")).agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of df, never per row of df.
    starts = counts.select("__chunk", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    joined = placed.withColumn("__chunk", chunk).join(starts, "__chunk")
    position = F.col("__before") + F.col("__id") - F.shiftleft(F.col("__chunk"), 33) + 1
    return joined.select(*df.columns, position.alias(name))


def sort(df, *order) -> DataFrame:
    return df.orderBy(*sort_keys(order))


def top(df, n, *order) -> DataFrame:
    """First ``n`` rows of the order; each task keeps n rows, so nothing is fully sorted."""
    return df.orderBy(*sort_keys(order)).limit(n)


def latest(df, col):
    """The greatest value of a column, as a scalar."""
    return df.agg(F.max(col)).first()[0]


def latest_row(df, order) -> DataFrame:
    return top(df, 1, *order)


def top_k(df, part, order, k, name="rank") -> DataFrame:
    """Rows ranked at most ``k`` in their group, ties kept.

    The rank filter lets each task drop all but its own first ``k`` (and their ties) before the
    shuffle, so what a group gathers follows its result and not its size. Where a huge share of a
    group may tie at the top, rank with ``rank_rows`` and filter instead.
    """
    window = Window.partitionBy(*part).orderBy(*sort_keys(order))
    return df.withColumn(name, F.rank().over(window)).filter(F.col(name) <= k).withColumn(name, F.col(name).cast("long"))
