"""What the exact vector searches share: integer rows, blocks of bounded size, selection with ties."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK, ROW_BLOCK, TILE = 4_096, 16_384, 128
KEYS = ["d", "query_block", "row_block"]


def integer_rows(vectors: DataFrame, scale: int, *others: Column) -> DataFrame:
    """Distinct rows (vec_id, others, v), v being floor(scale * x) of every component x taken as a double.

    Rows without vec_id and vectors that are null or hold null or non-finite components are left out.
    """
    wide = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *others, wide.alias("v")).filter("vec_id is not null and v is not null")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale))).distinct()


def blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def in_block(of: Column, pieces: int) -> Column:
    return F.pmod(of, F.lit(pieces).cast("long")).cast("int")


def grid(asked: DataFrame, rows: DataFrame, run: Callable[[pd.DataFrame, pd.DataFrame], Iterator[pd.DataFrame]], schema: str, query_blocks: int, row_blocks: int) -> DataFrame:
    """``run`` on every block of queries with every block of rows of one length.  Both sides of a task are bounded.

    ``asked`` has d and query_block, ``rows`` has d and row_block.
    """
    left = asked.withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    right = rows.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {c.split()[0]: {"long": "int64", "int": "int32", "double": "float64"}[c.split()[1]] for c in schema.split(", ")}

    def both(own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        found = list(run(own, other)) if len(own) and len(other) else []
        return pd.concat(found)[names] if found else pd.DataFrame({c: pd.Series([], dtype=k) for c, k in kinds.items()})

    return left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS)).applyInPandas(both, schema)


def matrix(column: pd.Series, kind=np.int64) -> np.ndarray:
    """Rows of a column of arrays, or of their bytes, as one matrix."""
    if len(column) and isinstance(column.iloc[0], bytes):
        return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)
    return np.array(column.tolist(), kind).reshape(len(column), -1)


def last_of_first(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every row the k-th largest value and the column where it stands; equal values count by column."""
    limit = np.partition(values, -k, axis=1)[:, -k]
    need = k - (values > limit[:, None]).sum(axis=1)
    return limit, (np.cumsum(values == limit[:, None], axis=1) >= need[:, None]).argmax(axis=1)


def first_places(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k largest values of every row, or all if fewer; equal values count by column."""
    if values.shape[1] <= k:
        return np.nonzero(np.ones(values.shape, bool))
    limit, last = last_of_first(values, k)
    r, c = np.nonzero(values >= limit[:, None])
    good = (values[r, c] > limit[r]) | (c <= last[r])
    return r[good], c[good]
