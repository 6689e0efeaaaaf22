"""Approximate nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph, which is cut into parts of equal size that cut few
edges; a small network learns the part of a vector.  Every row is indexed under its most probable
part, a query visits its most probable parts, and candidates there are ranked by exact cosine.
The number of parts visited is the least that finds ``AIM`` of the neighbours within the sample.
Parts are searched in chunks of bounded size, so a part that holds many equal vectors is many
tasks' work.  A query that finds too few candidates visits all parts.

Vectors that are null, zero, of another length than most or hold null or non-finite components
take no part.  A vec_id that stands more than once with one vector counts once; rows without
vec_id take no part.  With fewer candidates than asked for all are returned; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import staged

SAMPLE, GRAPH_NEIGHBOURS, HIDDEN = 4_000, 10, 64
ROWS_PER_PART, MOST_PARTS = 2_048, 64
CHUNK_ROWS = 4_096
AIM = 0.95


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row by cosine."""
    out = np.zeros((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        near = x[a : a + 512] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Part of each row: halves along the main direction, then moves to where most neighbours are, sizes kept near equal."""
    part = np.zeros(len(x), np.int64)
    groups = [(np.arange(len(x)), 0, parts)]
    while groups:
        rows, first, n = groups.pop()
        if n == 1:
            part[rows] = first
            continue
        own = x[rows] - x[rows].mean(axis=0)
        along = own @ np.linalg.svd(own, full_matrices=False)[2][0] if len(rows) > 1 else np.zeros(len(rows))
        order, cut = rows[np.argsort(along, kind="stable")], len(rows) * (n // 2) // n
        groups += [(order[:cut], first, n // 2), (order[cut:], first + n // 2, n - n // 2)]
    most = int(np.ceil(len(x) / parts * 1.1))
    sides = np.concatenate([graph, np.full((len(graph), 1), -1)], axis=1)
    back: list[list[int]] = [[] for _ in range(len(x))]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            back[j].append(i)
    around = [np.unique(np.array([*row[:-1], *back[i]], np.int64)) for i, row in enumerate(sides.tolist())]
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for i, near in enumerate(around):
            votes = np.bincount(part[near], minlength=parts).astype(float)
            votes[(sizes >= most) & (np.arange(parts) != part[i])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[i]]:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < len(x) / 200:
            break
    return part


class Router:
    """A network with one hidden layer that gives the probable parts of unit vectors."""

    def __init__(self, x: np.ndarray, part: np.ndarray, parts: int, steps: int = 150, seed: int = 0):
        rng = np.random.default_rng(seed)
        shapes = [(x.shape[1], HIDDEN), (1, HIDDEN), (HIDDEN, parts), (1, parts), (x.shape[1], parts)]
        self.w = [rng.normal(0, 1 / np.sqrt(a), (a, b)) * (i not in (1, 3)) for i, (a, b) in enumerate(shapes)]
        m, v = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        want = np.eye(parts)[part]
        for t in range(1, steps + 1):  # Adam on all rows
            hidden = np.tanh(x @ self.w[0] * 3 + self.w[1])
            wrong = (self.probabilities(x) - want) / len(x)
            inner = wrong @ self.w[2].T * (1 - hidden**2)
            slopes = [3 * x.T @ inner, inner.sum(axis=0, keepdims=True), hidden.T @ wrong, wrong.sum(axis=0, keepdims=True), x.T @ wrong]
            for i, g in enumerate(slopes):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
                self.w[i] -= 0.03 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-9)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(x @ self.w[0] * 3 + self.w[1]) @ self.w[2] + self.w[3] + 3 * x @ self.w[4]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, the most probable first."""
        return np.argsort(-self.probabilities(x), axis=1, kind="stable")


def fit(x: np.ndarray, rows: int, k: int) -> tuple[Router | None, int, int]:
    """Router, number of parts and number of parts to visit, from a sample of a table with so many rows."""
    parts = min(MOST_PARTS, -(-rows // ROWS_PER_PART), len(x) // 32)
    if parts < 2:
        return None, 1, 1
    x = unit(x)
    graph = neighbour_graph(x, min(GRAPH_NEIGHBOURS, len(x) - 1))
    router = Router(x, balanced_parts(x, graph, parts), parts)
    ranked = router.ranked(x)
    place = np.argsort(ranked, axis=1)  # of each part in each row's order
    nearest = graph[:, :k]
    found = place[np.arange(len(x))[:, None], ranked[nearest, 0]]
    visits = next(m for m in range(1, parts + 1) if m == parts or (found < m).mean() >= AIM)
    return router, parts, visits


def _usable(vectors: DataFrame) -> DataFrame:
    wide = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("v")).filter("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each query (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows = _usable(vectors)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, total = lengths
    rows = rows.filter(F.size("v") == dims)
    asked = _usable(queries).filter(F.size("v") == dims).dropDuplicates(["vec_id"])
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    router, parts, visits = fit(np.array(sample["v"].tolist(), float), total, k)
    learned = spark.sparkContext.broadcast(router)

    def route(count: int):
        def run(frames):
            for frame in frames:
                x = unit(np.array(frame["v"].tolist(), float)) if len(frame) else np.zeros((0, dims))
                ranked = learned.value.ranked(x)[:, :count] if learned.value is not None else np.zeros((len(x), 1), int)
                yield pd.DataFrame({"vec_id": frame["vec_id"].to_numpy(), "v": frame["v"].to_numpy(), "parts": ranked.tolist()})

        return run

    indexed = staged(rows.mapInPandas(route(1), "vec_id long, v array<double>, parts array<int>").select("vec_id", "v", F.get("parts", F.lit(0)).alias("part")), "neighbours-index")
    counts = {r.part: r["count"] for r in indexed.groupBy("part").count().collect()}
    chunks = {p: -(-n // CHUNK_ROWS) for p, n in counts.items()}
    pieces = F.element_at(F.create_map(*[F.lit(x) for pair in chunks.items() for x in pair]), F.col("part"))
    index = indexed.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), pieces.cast("long")).cast("int"))
    routed = staged(asked.mapInPandas(route(parts), "vec_id long, v array<double>, parts array<int>"), "neighbours-queries")

    def search(of: DataFrame, count: int) -> DataFrame:
        visited = of.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.explode(F.slice("parts", 1, count)).alias("part"))
        visited = visited.filter(F.col("part").isin(*chunks)).withColumn("chunk", F.explode(F.sequence(F.lit(0), pieces.cast("int") - 1)))
        return visited.groupBy("part", "chunk").cogroup(index.groupBy("part", "chunk")).applyInPandas(_ranker(k), schema)

    found = staged(search(routed, visits), "neighbours-found")
    enough = min(k, indexed.limit(k + 1).count() - 1)
    if visits < parts:
        full = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).filter(F.col("n") >= enough)
        short = routed.join(full.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
        found = found.union(search(short, parts))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def _ranker(k: int):
    def run(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        rows = rows.drop_duplicates("vec_id")
        ids, x = rows["vec_id"].to_numpy(), np.array(rows["v"].tolist(), float)
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        out = []
        for query, v in zip(asked["query_id"].to_numpy(), asked["q"]):
            q = np.array(v, float)
            size = np.sqrt(np.einsum("j,j->", q, q))
            rough = x @ q / (norms * size)
            rough[ids == query] = -np.inf
            if len(rough) > k:  # those that may be among the first, whatever the last digits are
                at = np.nonzero(rough >= np.partition(rough, -k)[-k] - 1e-9)[0]
            else:
                at = np.arange(len(rough))
            at = at[ids[at] != query]
            score = np.einsum("ij,j->i", x[at], q) / (norms[at] * size)
            first = np.lexsort((ids[at], -score))[:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[at][first], "score": score[first]}))
        return pd.concat(out)

    return run
