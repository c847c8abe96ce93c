"""Running values over a total order of all rows, without one task that sees them all.

Rows are written in ranges of the order. Each range sums up its own rows, these few totals are
carried from range to range, and windows within a range do the rest. A group that holds most rows
spreads over as many ranges as it fills. The result depends on the order alone, not on where the
ranges end.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import parallelism, staged

PART = "_part"


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    width = parallelism(df.sparkSession)
    return staged(df.repartitionByRange(width, *order).withColumn(PART, F.spark_partition_id()), "ranges")


def _carried(ranged: DataFrame, totals: DataFrame, group: list[str]) -> DataFrame:
    return ranged.join(totals, [PART, *group])


def _before(group: list[str]):
    return Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def _local(group: list[str], order: list[str]):
    window = Window.partitionBy(PART, *group).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sums(
    df: DataFrame, group: list[str], order: list[str], sums: dict[str, Column],
    attach: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``df`` with the sum of each value over the rows of the group up to and with this one.

    Group columns hold no nulls. Rows that tie in the order get their sums in any order. ``attach``
    may make more columns of each group from the groups' sums; these travel with what is carried,
    at no further shuffle of the rows.
    """
    named = {f"_{name}": value for name, value in sums.items()}
    ranged = _ranged(df.withColumns(named), [*group, *order])
    totals = ranged.groupBy(PART, *group).agg(*[F.sum(n).alias(n) for n in named])
    before = totals.select(
        PART, *group, *[F.coalesce(F.sum(n).over(_before(group)), F.lit(0)).alias(f"_before{n}") for n in named]
    )
    if attach is not None:
        whole = totals.groupBy(*group).agg(*[F.sum(f"_{n}").alias(n) for n in sums])
        before = before.join(attach(whole), group)
    local = _local(group, order)
    full = {n: F.col(f"_before_{n}") + F.sum(f"_{n}").over(local) for n in sums}
    done = _carried(ranged, before, group).withColumns(full)
    return done.drop(PART, *named, *[f"_before{n}" for n in named])


def running_last(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the last value that is not null among the rows up to and with this one."""
    ranged = _ranged(df, order)
    place = F.struct(*order)
    totals = ranged.where(F.col(value).isNotNull()).groupBy(PART).agg(F.max_by(value, place).alias("_last"))
    parts = ranged.select(PART).distinct().join(totals, PART, "left")
    before = parts.select(PART, F.last("_last", ignorenulls=True).over(_before([])).alias("_before"))
    here = F.last(value, ignorenulls=True).over(_local([], order))
    return _carried(ranged, before, []).withColumn(name, F.coalesce(here, "_before")).drop(PART, "_before")


def running_lasts(df: DataFrame, order: list[str], values: dict[str, Column]) -> DataFrame:
    """``df`` with, for each named value, the last that is not null up to and with this row.

    As ``running_last`` for several values, in one pass over the rows.
    """
    ranged = _ranged(df.withColumns(values), order)
    place = F.struct(*order)
    last = [F.max_by(n, F.when(F.col(n).isNotNull(), place)).alias(f"_last{n}") for n in values]
    totals = ranged.groupBy(PART).agg(*last)
    carried = {f"_before{n}": F.last(f"_last{n}", ignorenulls=True).over(_before([])) for n in values}
    before = totals.select(PART, *[value.alias(n) for n, value in carried.items()])
    local = _local([], order)
    filled = {n: F.coalesce(F.last(n, ignorenulls=True).over(local), f"_before{n}") for n in values}
    return _carried(ranged, before, []).withColumns(filled).drop(PART, *carried)
