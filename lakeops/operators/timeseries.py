"""Period-over-period variation and the expansion of n-monthly series to months."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of the sample for each range, and periods up to which a range's last rows are carried over; a longer way back is a join by row number.
SAMPLED, MOST_CARRIED = 50, 1000
MONTHS = {"bi-monthly": 2, "quarterly": 3, "four-monthly": 4, "six-monthly": 6}


def _change(value: Column, earlier: Column, percentage: bool, base: str) -> Column:
    """Zero where the earlier value is zero or missing; percentages of the current value, or of the previous one."""
    before = F.coalesce(earlier, F.lit(0))
    change = value - before
    if percentage:
        change = F.try_divide(change, value if base == "current" else before) * 100
    return F.when(before == 0, F.lit(0.0)).otherwise(change)


def variation(df: DataFrame, column: str, time: str, output: str, periods: int = 1, partition_by: list[str] | None = None, percentage: bool = False, base: str = "current", ties: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """``column`` against its value ``periods`` rows before in the order of ``time`` (then ``ties``).

    Without ``partition_by`` the order is global. Rows are dealt to ranges of it, each of which looks back inside itself, and its first rows into the last ones of the ranges
    before, a table of at most ``periods`` rows a range; rows move once, and no task holds all of them."""
    order = [time, *(ties or [])]
    if partition_by:
        earlier = F.lag(column, periods).over(Window.partitionBy(*partition_by).orderBy(*order))
        return df.withColumn(output, _change(F.col(column), earlier, percentage, base))
    if periods > MOST_CARRIED:
        numbered = global_row_number(df, order, "_at", ranges)
        before = numbered.select((F.col("_at") + periods).alias("_at"), F.col(column).alias("_before"))
        return numbered.join(before, "_at", "left").withColumn(output, _change(F.col(column), F.col("_before"), percentage, base)).select(*df.columns, output)
    spot = _range_of(df, order, ranges)
    # the last rows of each range; only ``periods`` rows a range and task are shuffled
    backwards = Window.partitionBy("_range").orderBy(*(F.desc(c) for c in order))
    tails = df.select(spot.alias("_range"), F.col(column).alias("_before"), *order).withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= periods)
    carried, last = [], []
    for number, own in groupby(sorted(tails.select("_range", "_back", "_before").collect(), key=lambda r: (r["_range"], -r["_back"])), key=lambda r: r["_range"]):
        carried += [(number, i, before) for i, before in enumerate(last, periods - len(last) + 1)]
        last = (last + [r["_before"] for r in own])[-periods:]
    carried = df.sparkSession.createDataFrame(carried, T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_in", T.IntegerType()), T.StructField("_before", df.schema[column].dataType)]))
    inside = Window.partitionBy("_range").orderBy(*order)
    own = df.withColumn("_range", spot).withColumns({"_in": F.row_number().over(inside), "_lag": F.lag(column, periods).over(inside)})
    earlier = F.when(F.col("_in") > periods, F.col("_lag")).otherwise(F.col("_before"))
    return own.join(F.broadcast(carried), ["_range", "_in"], "left").withColumn(output, _change(F.col(column), earlier, percentage, base)).select(*df.columns, output)


def global_row_number(df: DataFrame, order: list[str], output: str, ranges: int | None = None) -> DataFrame:
    """Row numbers from 1 in a global order: numbers inside each range, plus the rows of the ranges before it (a table of a row a range).
    The order should be unique; rows that tie are numbered as they come."""
    spot = _range_of(df, order, ranges)
    sizes = df.groupBy(spot.alias("_range")).agg(F.count("*").alias("_size"))
    before = sizes.select("_range", (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_skip"))
    inside = df.withColumn("_range", spot).withColumn("_in", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return inside.join(F.broadcast(before), "_range").withColumn(output, F.col("_in") + F.col("_skip")).select(*df.columns, output)


def _range_of(df: DataFrame, order: list[str], ranges: int | None) -> Column:
    """The number of a row's range: bounds come from a sample of ``SAMPLED`` rows a range and stand in the plan, so every use of them deals alike."""
    ranges = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = df.select(*order).orderBy(F.rand(17)).limit(SAMPLED * ranges).orderBy(*order).collect()
    bounds = list(dict.fromkeys(some[len(some) * i // ranges] for i in range(1, ranges))) if some else []
    key, kinds = F.struct(*order), [df.schema[c].dataType for c in order]

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        bound = F.struct(*(F.lit(v).cast(k).alias(c) for v, k, c in zip(bounds[middle], kinds, order, strict=True)))
        return F.when(key < bound, pick(low, middle)).otherwise(pick(middle + 1, high))

    return pick(0, len(bounds))


def monthly_converter(df: DataFrame, id_column: str, date: str, kind: str, ordered: bool = False) -> DataFrame:
    """Series that arrive every n months as monthly ones: a row on frequency stands for its own month and the n-1 before it.

    A row is on frequency if it lies n months after the one before it of the same id; the first row of an id is measured by its month number.
    Of an id's rows off frequency only those of its last date are kept, the tail that is not complete yet: each stands for the months of its own gap.
    Every id is on its own, whatever the others have; one shuffle by id serves both. ``ordered`` sorts the output by date, for a reader that needs it."""
    n = MONTHS[kind]
    month = F.year(date) * 12 + F.month(date)
    of_id = Window.partitionBy(id_column)
    gap = F.coalesce(month - F.lag(month).over(of_id.orderBy(date)), F.month(date))
    marked = df.withColumn("_gap", gap).withColumn("_last", F.max(F.when(F.col("_gap") != n, F.col(date))).over(of_id))
    kept = marked.where((F.col("_gap") == n) | (F.col(date) == F.col("_last")))
    kept = kept.withColumn("_back", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_gap"), F.lit(1)) - 1)))
    months = kept.withColumn(date, F.add_months(date, -F.col("_back")).cast(df.schema[date].dataType)).select(*df.columns)
    return months.orderBy(date) if ordered else months
