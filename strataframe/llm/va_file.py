"""Exact top-k by integer inner product over a vector-approximation file.

Every component is quantised into one of ``CELLS`` cells of its position, cut where all rows
divide evenly, so a vector is a byte per component.  A cell is a range of integers, hence a row of
bytes bounds the score with any query from both sides.  The scan reads these bytes only: a row
stays if its upper bound reaches the k-th lower bound of its block and the k-th lower bound of a
sixteenth of the rows.  Then exact vectors are read in the order of their bounds, the first
``AHEAD * k`` of a query; the k-th exact score says which of the others must be read as well.

Equal vectors are one class and are scanned once, with their smallest ids; so a vector that a
third of all rows share costs no more than another, as query and as candidate.

Vectors that are null or hold null or non-finite components and rows without vec_id take no part.
Equal rows count once.  If a vec_id has several vectors, its score with another id is the largest
of theirs, and no id is compared with itself.  Vectors of different lengths have no score; empty
vectors score 0 with each other.  Equal scores go to the smaller vec_id; with fewer candidates all
are returned.  An empty table gives no rows; other columns are ignored.  A score beyond a signed
64-bit integer is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import staged
from strataframe.llm.vectors import QUERY_BLOCK, ROW_BLOCK, TILE, blocks, grid, in_block, integer_rows, last_of_first, matrix

CELLS = 64
SHARE = 16  # one row in so many gives the first limit of a query
AHEAD = 2


def cell_limits(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest integer of each cell of each position, from all rows; one row per position comes to the driver."""
    parts = [(i + 1) / CELLS for i in range(CELLS - 1)]
    cuts = F.percentile_approx("x", F.array(*map(F.lit, parts)), F.lit(20 * CELLS))
    by_place = classes.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(cuts.alias("cuts"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    found = by_place.orderBy("i").collect()
    low, high = np.zeros((len(found), CELLS), np.int64), np.zeros((len(found), CELLS), np.int64)
    for row in found:
        ends = sorted({*row.cuts, row.hi})  # a cell reaches from above the end before to its own end
        high[row.i] = ends + [row.hi] * (CELLS - len(ends))
        low[row.i, 0], low[row.i, 1:] = row.lo, high[row.i, :-1] + 1
    return low, high


def cells_of(v: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The cell of each component: the first that ends at or above it."""
    return np.stack([np.searchsorted(high[i], v[:, i]) for i in range(v.shape[1])], axis=1).astype(np.uint8) if v.shape[1] else np.zeros(v.shape, np.uint8)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of queries with rows that lie between ``low`` and ``high``."""
    up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    lo, hi = low.T.astype(float), high.T.astype(float)
    most = float(np.abs(q).max(initial=0)) * max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0)) * q.shape[1]
    slack = 0.0 if most < 2**53 else most * 2.0**-45  # sums of integers are exact below
    return up @ lo + down @ hi - slack, up @ hi + down @ lo + slack


def _scan(k: int, low: np.ndarray, high: np.ndarray):
    """Rows of a block that a query cannot rule out, with their bounds."""

    def run(asked: pd.DataFrame, rows: pd.DataFrame):
        rows = rows.sort_values("first", kind="stable")
        first, names = rows["first"].to_numpy(), rows["class"].to_numpy()
        cells, d = matrix(rows["cells"], np.uint8), int(rows["d"].iloc[0])
        at = np.arange(d)
        lo, hi = low[at, cells], high[at, cells]
        counted = np.sort(np.unique(first, return_index=True)[1])  # an id counts once
        for a in range(0, len(asked), TILE):
            some = asked.iloc[a : a + TILE]
            lower, upper = bounds(matrix(some["q"]), lo, hi)
            limits = [(some["limit"].fillna(-np.inf).to_numpy(float), some["limit_id"].to_numpy())]
            if len(counted) >= k:
                limit, last = last_of_first(lower[:, counted], k)
                limits.append((limit, first[counted[last]]))
            r, c = np.nonzero(upper >= np.maximum.reduce([x for x, _ in limits])[:, None])
            for limit, last in limits:
                good = (upper[r, c] > limit[r]) | (first[c] <= last[r])
                r, c = r[good], c[good]
            yield pd.DataFrame({"query_class": some["query_class"].to_numpy()[r], "class": names[c], "first": first[c], "lower": lower[r, c], "upper": upper[r, c]})

    return run


def _top(scores: DataFrame, by: str, k: int) -> DataFrame:
    """The k best of each query with their places; of several scores of one id the largest counts."""
    best = scores.groupBy(by, "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score of the k highest inner products of each row that ``is_query`` picks by its vec_id."""
    wanted = k + 1  # a query finds itself
    rows = integer_rows(vectors, scale)
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    groups = rows.withColumn("place", smallest).filter(F.col("place") <= wanted).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = staged(groups.withColumn("class", F.monotonically_increasing_id()), "va-vectors")
    asking = staged(rows.filter(is_query).join(classes.select("v", F.col("class").alias("query_class")), "v").select(F.col("vec_id").alias("query_id"), "query_class"), "va-queries")
    low, high = cell_limits(classes)
    limits = classes.sparkSession.sparkContext.broadcast((low, high))
    row_blocks = blocks(classes.count(), ROW_BLOCK)

    def encode(frames):
        for frame in frames:
            for _, same in frame.groupby(frame["v"].map(len)):
                cells = cells_of(matrix(same["v"]), limits.value[1])
                yield same.drop(columns="v").assign(cells=[c.tobytes() for c in cells])

    laid = classes.select("class", F.get("ids", F.lit(0)).alias("first"), F.size("v").alias("d"), in_block(F.xxhash64("v"), row_blocks).alias("row_block"), (F.pmod(F.xxhash64("class"), F.lit(SHARE)) == 0).alias("ahead"), "v")
    file = staged(laid.mapInPandas(encode, "class long, first long, d int, row_block int, ahead boolean, cells binary"), "va-file")
    asked = classes.join(asking.select(F.col("query_class").alias("class")).distinct(), "class").select(F.col("class").alias("query_class"), F.col("v").alias("q"), F.size("v").alias("d"))
    asked = staged(asked, "va-asked")
    query_blocks = blocks(asked.count(), QUERY_BLOCK)
    asked = asked.withColumn("query_block", in_block(F.xxhash64("query_class"), query_blocks))

    def scan(of: DataFrame, part: DataFrame) -> DataFrame:
        schema = "query_class long, class long, first long, lower double, upper double"
        return grid(of, part, lambda a, b: _scan(wanted, *limits.value)(a, b), schema, query_blocks, row_blocks)

    free = asked.withColumns({"limit": F.lit(None).cast("double"), "limit_id": F.lit(0).cast("long")})
    early = scan(free, file.filter("ahead")).select("query_class", F.col("first").alias("vec_id"), F.col("lower").alias("score"))
    early = _top(early, "query_class", wanted).filter(F.col("rank") == wanted).select("query_class", F.col("score").alias("limit"), F.col("vec_id").alias("limit_id"))
    limited = asked.join(early, "query_class", "left").withColumn("limit_id", F.coalesce("limit_id", F.lit(0).cast("long")))
    left = staged(scan(limited, file).drop("lower"), "va-candidates")

    def exact(pairs: DataFrame) -> DataFrame:
        both = pairs.select("query_class", "class").join(asked.select("query_class", "q"), "query_class").join(classes, "class")
        score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return both.select("query_class", "ids", score.alias("score")).select("query_class", F.explode("ids").alias("vec_id"), "score")

    order = F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("upper"), "first"))
    near = staged(left.withColumn("place", order).filter(F.col("place") <= AHEAD * wanted).drop("place"), "va-near")
    read = staged(exact(near), "va-read")
    sure = _top(read, "query_class", wanted).filter(F.col("rank") == wanted).select("query_class", F.col("score").alias("s"), F.col("vec_id").alias("i"))
    open_ = F.col("s").isNull() | (F.col("upper") > F.col("s")) | ((F.col("upper") == F.col("s")) & (F.col("first") < F.col("i")))
    rest = left.join(near, ["query_class", "class"], "left_anti").join(sure, "query_class", "left").filter(open_)
    tops = _top(read.union(exact(rest)), "query_class", wanted).drop("rank")
    found = asking.join(tops, "query_class").filter("vec_id <> query_id").select("query_id", "vec_id", "score")
    return _top(found, "query_id", k).select("query_id", "rank", "vec_id", "score")
