"""Tables partitioned by ranges of a column, of which single ranges are replaced or dropped by a commit."""

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import literal
from ..operators.layout import range_bucket
from .files import PART, FileTable, plain


class RangeTable(FileTable):
    """RANGE RIGHT partitions of ``column``: number 0 before the first bound, i from bound i on. Rows without a value lie in number 0.

    The number is a folder, so a filter on the column that ``between`` turns into a bound on the number prunes folders in the plan.
    """

    def __init__(self, spark, path, column, bounds):
        super().__init__(spark, path, column)
        self.bounds = sorted(bounds)

    def number(self):
        return F.coalesce(range_bucket(self.watermark, self.bounds), F.lit(0))

    def append(self, df, batch=None, source="append"):
        state = self.state()
        if batch is not None and state["marks"].get(source, -1) >= batch:
            return None
        schema = plain(df.schema)
        folder = self.write_files(df, self.number(), [self.watermark])
        return self.publish(state, schema, self.measured(folder, schema), marks=None if batch is None else {source: batch})

    def switch(self, number, df=None):
        """Replace range ``number`` by ``df``, or drop it. Rows of ``df`` outside the range fail the write. Other ranges' files keep their names."""
        state = self.state()
        old = self.files(state).where(F.col("part") == number)
        if df is None:
            return self.publish(state, self.schema(state), self.files(state).limit(0), old, changes_base=True)
        outside = F.raise_error(F.concat(F.lit(f"a row of range {number} lies in range "), self.number().cast("string"))).cast("int")
        schema = plain(df.schema)
        folder = self.write_files(df, F.when(self.number() == number, F.lit(number)).otherwise(outside), [self.watermark])
        return self.publish(state, schema, self.measured(folder, schema), old, changes_base=True)

    def numbers(self, low=None, high=None):
        """First and last range that can hold values in ``[low, high]``."""
        first = 0 if low is None else bisect_right(self.bounds, low)
        last = len(self.bounds) if high is None else bisect_right(self.bounds, high)
        return first, last

    def between(self, low=None, high=None, state=None) -> DataFrame:
        """Rows with ``low <= column <= high``; an open bound is None. The filter on the column comes with one on the range's number."""
        state = state or self.state()
        rows = self.scan(self.files(state), state, folders=True)
        first, last = self.numbers(low, high)
        dtype, column = rows.schema[self.watermark].dataType, F.col(f"`{self.watermark}`")
        keep = F.col(PART).between(first, last)
        if low is not None:
            keep &= column >= literal(low, dtype)
        if high is not None:
            keep &= column <= literal(high, dtype)
        return rows.where(keep).drop("load__", PART)

