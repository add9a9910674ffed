"""Shared DataFrame helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import scratch_path, ship_package


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back, for frames that several
    steps read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bind_once(df: DataFrame, name: str, expr: Column, keep=None) -> DataFrame:
    """Add column ``name`` = ``expr`` evaluated exactly once per row
    (optionally keeping only rows where ``keep(value)`` holds).

    Catalyst pushes filters below projections by substituting aliases, so an
    expensive expression (a JSON parse, a text cleaner) referenced by later
    predicates and projections would run once per reference. Binding it as
    the single element of a generated array makes the value an attribute of
    the generator's output, computed once.
    """
    arr = F.array(expr)
    if keep is not None:
        arr = F.filter(arr, lambda v: keep(v))
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(arr).alias(name))


def mapped(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``fn`` over the Arrow batches of every task, in batches of bounded size."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def lists(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lengths and items of a list column, one after the other; a null has none."""
    return values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), values.flatten()


def as_lists(sizes: np.ndarray, items: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), items)
