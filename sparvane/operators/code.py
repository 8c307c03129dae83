"""Places for own code: over all items, per item, per group, one to many; and metrics on the side."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def over_items(df: DataFrame, code: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str) -> DataFrame:
    """``code`` gets the items in Arrow batches; it must not depend on how they are batched."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield code(batch)

    return df.mapInPandas(run, schema)


def per_item(code: Callable[[pd.Series], pd.Series], returns: str) -> Callable[[Column], Column]:
    """A vectorised function of a column."""
    return F.pandas_udf(code, returns)


def per_group(df: DataFrame, by: list[str], code: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str) -> DataFrame:
    """``code`` gets a whole group: only for groups that fit a task, such as one conversation."""
    return df.groupBy(*by).applyInPandas(code, schema)


def one_to_many(df: DataFrame, column: str, code: Callable[[object], Iterable], element: str, name: str = "item") -> DataFrame:
    """Each row once for every value that ``code`` gives for its column."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: list(code(v)))

    return df.withColumn(name, F.explode(F.pandas_udf(run, f"array<{element}>")(column)))


def map_reduce_text(
    chunks: DataFrame, by: list[str], order: str, text: str, shorten: Callable[[str], str], combine: Callable[[list[str]], str]
) -> DataFrame:
    """``(by, summary)``: every chunk is shortened where it lies, then each group's are combined in order."""

    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else shorten(v))

    short = chunks.select(*by, order, F.pandas_udf(run, "string")(text).alias("_s")).where("_s is not null")
    lists = short.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "_s"))), lambda x: x["_s"]).alias("_l"))
    return lists.select(*by, F.pandas_udf(lambda s: s.map(lambda v: combine(list(v))), "string")("_l").alias("summary"))


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and figures about them that are there once an action has run."""
    observation = Observation(name)
    return df.observe(observation, *[c.alias(n) for n, c in metrics.items()]), observation


#: Workflows that others may call, by name.
_WORKFLOWS: dict[str, Callable[..., DataFrame]] = {}
_RUNNING: list[str] = []


def workflow(name: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Registers a function of frames as a workflow."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _WORKFLOWS[name] = f
        return f

    return add


def call_workflow(name: str, *inputs: DataFrame, **options) -> DataFrame:
    """The frame that another workflow makes of the inputs; its plan becomes part of the caller's. A workflow may not call itself."""
    if name not in _WORKFLOWS:
        raise KeyError(f"no workflow is named {name!r}")
    if name in _RUNNING:
        raise RecursionError(" -> ".join([*_RUNNING, name]))
    _RUNNING.append(name)
    try:
        return _WORKFLOWS[name](*inputs, **options)
    finally:
        _RUNNING.pop()
