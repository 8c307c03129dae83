"""Splitting, gathering, routing and ordering of items."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import SLICE_ROWS, _spare, with_position


def split_out(df: DataFrame, field: str, keep_empty: bool = False, position: str | None = None) -> DataFrame:
    """One row per element of ``field``; null and empty lists give no row unless kept, then a null."""
    others = [c for c in df.columns if c != field]
    if position:
        explode = F.posexplode_outer if keep_empty else F.posexplode
        return df.select(*others, explode(field).alias(position, field))
    return df.select(*others, (F.explode_outer if keep_empty else F.explode)(field).alias(field))


def aggregate_items(df: DataFrame, field: str | None = None, by: list[str] | None = None, name: str = "items") -> DataFrame:
    """All values of a field (or whole rows) in one sorted list per group; nulls are dropped."""
    items = F.array_sort(F.collect_list(F.col(field) if field else F.struct("*"))).alias(name)
    return df.groupBy(*(by or [])).agg(items)


#: Summaries by name; each takes a column and gives an aggregate.
SUMMARIES: dict[str, Callable[[str], Column]] = {
    "count": F.count,
    "count_unique": F.count_distinct,
    "sum": F.sum,
    "average": F.avg,
    "min": F.min,
    "max": F.max,
    "append": lambda c: F.array_sort(F.collect_list(c)),
    "concatenate": lambda c: F.array_join(F.array_sort(F.collect_list(F.col(c).cast("string"))), ","),
}


def summarize(df: DataFrame, by: list[str], summaries: list[tuple[str, str, str]]) -> DataFrame:
    """Group by ``by`` and compute ``(summary, column, name)``; aggregates ignore nulls."""
    return df.groupBy(*by).agg(*[SUMMARIES[kind](column).alias(name) for kind, column, name in summaries])


def if_branch(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition is true, and all others, those where it is null included."""
    true = F.coalesce(condition, F.lit(False))
    return df.where(true), df.where(~true)


def switch_route(df: DataFrame, rules: list[tuple[str, Column]], fallback: str = "fallback", name: str = "route") -> DataFrame:
    """The name of the first rule that is true, else the fallback, as a column."""
    route = F.lit(fallback)
    for label, condition in reversed(rules):
        route = F.when(condition, label).otherwise(route)
    return df.withColumn(name, route)


def set_fields(df: DataFrame, fields: dict[str, Column], keep_only: bool = False) -> DataFrame:
    if keep_only:
        return df.select(*[c.alias(n) for n, c in fields.items()])
    return df.withColumns(fields)


def rename_keys(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def stop_on(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Pass rows on; the job fails with ``message`` if the condition is true for any."""
    checked = F.when(F.coalesce(condition, F.lit(False)), F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.where(checked)


def ordering(keys: list[tuple[str, bool]], nulls_last: bool = True, backwards: bool = False) -> list[Column]:
    """Sort keys of ``(column, ascending)`` pairs; ``backwards`` gives the very opposite order."""
    out = []
    for column, ascending in keys:
        c, last = F.col(column), nulls_last != backwards
        if ascending != backwards:
            out.append(c.asc_nulls_last() if last else c.asc_nulls_first())
        else:
            out.append(c.desc_nulls_last() if last else c.desc_nulls_first())
    return out


def sort_items(df: DataFrame, *keys: tuple[str, bool], nulls_last: bool = True) -> DataFrame:
    """Sort by ``(column, ascending)``; nulls last (or first) in either direction."""
    return df.orderBy(*ordering(list(keys), nulls_last))


def limit_items(df: DataFrame, n: int, keys: list[tuple[str, bool]], last: bool = False) -> DataFrame:
    """The first (or last, from the end) ``n`` rows in the order of ``keys``: a top-k per task, then one merge."""
    return df.orderBy(*ordering(keys, backwards=last)).limit(n)


def split_in_batches(df: DataFrame, size: int, order: list[Column], name: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows in a total order, numbered from 0."""
    return with_position(df, order, "_p").withColumn(name, F.floor(F.col("_p") / size)).drop("_p")


def unpivot(df: DataFrame, ids: list[str], columns: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, columns, variable, value)


def pivot_counts(df: DataFrame, by: list[str], column: str, values: list, prefix: str = "") -> DataFrame:
    """Rows per group and value, a column for each of ``values`` (named ``prefix`` and the value); 0 where there are none."""
    out = df.groupBy(*by).pivot(column, values).count()
    return out.select(*by, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"{prefix}{v}") for v in values])


def grouped_counts(df: DataFrame, by: list[str], sets: str | list[list[str]]) -> DataFrame:
    """``(by, level, n)``: rows per ``cube``, ``rollup`` or list of grouping sets; ``level`` has a bit for each column summed over."""
    keys = [F.col(c) for c in by]
    if sets == "cube":
        grouped = df.cube(*keys)
    elif sets == "rollup":
        grouped = df.rollup(*keys)
    else:
        grouped = df.groupingSets([[F.col(c) for c in some] for some in sets], *keys)
    return grouped.agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


def item_lists(df: DataFrame, operation: str, **options) -> DataFrame:
    """The older single operator: dispatches to the ones above."""
    from .relational import remove_duplicates

    return {
        "split_out": split_out, "aggregate": aggregate_items, "remove_duplicates": remove_duplicates,
        "sort": lambda d, keys: sort_items(d, *keys), "limit": limit_items, "summarize": summarize,
    }[operation](df, **options)


def last_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The last ``k`` rows per group: a conversation's memory window.

    Tasks keep at most ``k`` rows per group before the shuffle, so a group that most rows have is no burden.
    """
    newest = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= k).drop("_n")


first_n = last_k


def rolling_list(df: DataFrame, by: list[str], order: list[Column], field: str, k: int, name: str = "window") -> DataFrame:
    """With each row, its group's last ``k`` values of ``field`` up to and with its own, in order; nulls are left out.

    The ordered table is cut into slices, each with the ``k - 1`` rows before it, so no task has a whole group to order.
    """
    place, piece, more = _spare(df, "_p", "_slice", "_more")
    size = max(SLICE_ROWS, k)
    rows = with_position(df, [*map(F.col, by), *order], place)
    own = F.floor(F.col(place) / size)
    next_too = F.when(F.col(place) % size >= size - (k - 1), F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.withColumn(piece, F.explode(next_too)).withColumn(more, F.col(piece) != own)
    frame = Window.partitionBy(piece, *by).orderBy(place).rowsBetween(-(k - 1), 0)
    return spread.withColumn(name, F.collect_list(field).over(frame)).where(~F.col(more)).drop(place, piece, more)


def dedupe_suffix(df: DataFrame, column: str, order: list[Column], within: list[str] | None = None) -> DataFrame:
    """Unique names: the second and later rows of a name get `` 2``, `` 3``, ...; nulls stay null.

    A row's number is its position less that of its name's first row in one order of all rows, so a name that most
    rows have is spread over many tasks.
    """
    place, first = _spare(df, "_p", "_first")
    keys = [*(within or []), column]
    rows = with_position(df, [*map(F.col, keys), *order], place)
    firsts = rows.groupBy(*keys).agg(F.min(place).alias(first)).withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(keys)})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])
    n = F.col(place) - F.col(first) + 1
    named = F.when((n > 1) & F.col(column).isNotNull(), F.concat_ws(" ", column, n)).otherwise(F.col(column))
    return rows.join(firsts, same).withColumn(column, named).select(*df.columns)


def keep_newest(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The newest ``n`` rows with ``keep = true``, all others with false (to be deleted)."""
    placed = with_position(df, order)
    return placed.withColumn("keep", F.col("position") < n).drop("position")
