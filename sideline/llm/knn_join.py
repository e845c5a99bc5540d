"""Exact top-k search by inner product as a Voronoi join of queries and data."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm.vectors import matrix, usable

_FIT = 2.0**53


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    """The further component that gives every data vector the same length: sqrt(most - |x|^2)."""
    return np.sqrt(np.maximum(most - np.einsum("ij,ij->i", x, x), 0.0))


def _distances(x: np.ndarray, lift: np.ndarray, p: np.ndarray, p_lift: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", p, p)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(square + (lift[:, None] - p_lift[None, :]) ** 2, 0.0))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; where a double can't hold them, by Python's integers, held to long."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if bound < _FIT:
        return (q @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q).dot(whole(x.T)) if q.size and x.size else np.zeros((len(q), len(x)), object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def top_k(
    queries: DataFrame, data: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id",
    vec_col: str = "embedding", pivots: int = 64, query_rows: int = 2048, data_rows: int = 16384,
) -> DataFrame:
    """The ``k`` rows of ``data`` with the highest score for every row of ``queries``.

    Components become floor(scale * x); the score is the integer inner product, ties go to the
    smaller id. One more component, sqrt(M - |x|^2) for data and 0 for queries (M the largest
    squared length), turns the order by inner product into the order by distance.

    1. ``pivots`` data vectors (those with the smallest id hashes; a fixed number) divide the space
       into Voronoi cells. One pass finds each row's cell and its distance to that pivot.
    2. Summaries, a few numbers per cell: rows, the largest distance of a query, and the k + 1
       smallest distances of data with different ids. They bound, for all queries of a cell, the
       distance of the k-th neighbour by the triangle inequality over pivots (k + 1 ids, as a query
       can be data itself, in any number of rows and cells).
    3. Cells of queries are put together in groups of about ``query_rows``, larger cells are split.
       A data row goes to a group only if its distance to a pivot of the group is within the
       group's bound: no other row can be among the k.
    4. Each group meets the data in blocks of about ``data_rows``, so memory is bounded whatever one
       cell holds; every block gives its best k per query, and the best k of those are the result.

    Returns query_id, rank (from 1), vec_id, score. A query is no candidate for itself: rows with
    its id are left out. Vectors that are null or hold null or non-finite components and rows with a
    null id take no part; shorter vectors count as filled up with zeros; equal query rows are
    answered once. Fewer candidates than ``k`` give fewer rows; empty tables give none. Columns
    other than id and vector are not read.
    """
    def ready(df: DataFrame) -> DataFrame:
        whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
        return df.filter(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(F.col(id_col).cast("long").alias("id"), whole.alias("vec"))

    data = ready(data)
    queries = ready(queries).distinct()
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    width, most, n_data = data.agg(F.max(F.size("vec")), F.max(square), F.count(F.lit(1))).first()
    width = max(width or 1, queries.agg(F.max(F.size("vec"))).first()[0] or 1)
    most = most or 0.0
    chosen = data.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    p = np.unique(matrix([r.vec for r in chosen] or [[0.0]], width), axis=0)
    p_lift = _lifted(p, most)

    def cells(batches: Iterator[pd.DataFrame], lift_up: bool) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = matrix(pdf["vec"], width)
            d = _distances(x, _lifted(x, most) if lift_up else np.zeros(len(x)), p, p_lift)
            cell = d.argmin(1) if len(d) else np.empty(0, np.int64)
            yield pdf.assign(cell=cell.astype(np.int32), distance=d[np.arange(len(d)), cell])

    coded = "id long, vec array<double>, cell int, distance double"
    in_cells = written(queries.mapInPandas(lambda it: cells(it, False), coded), "knn-queries")
    near = Window.partitionBy("cell").orderBy("distance")
    closest = (
        data.mapInPandas(lambda it: cells(it, True), coded).groupBy("cell", "id").agg(F.min("distance").alias("distance"))
        .withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1)
    )
    # both are bounded by the number of pivots
    near_pivots = closest.select("cell", "id", "distance").orderBy("id").toPandas()
    counts = in_cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far")).toPandas()

    between = _distances(p, p_lift, p, p_lift)
    ids = counts["cell"].to_numpy(np.int64)
    far = counts["far"].to_numpy(np.float64)
    # by cell of queries: the (k + 1)-th smallest upper bound over the ids in the summaries of data
    upper = far[:, None] + between[np.ix_(ids, near_pivots["cell"].to_numpy(np.int64))] + near_pivots["distance"].to_numpy()[None, :]
    if len(near_pivots):
        upper = np.minimum.reduceat(upper, np.unique(near_pivots["id"].to_numpy(np.int64), return_index=True)[1], axis=1)
    kth = np.sort(upper, axis=1)[:, k] if upper.shape[1] > k else np.full(len(ids), np.inf)
    reach = (far + kth) * (1 + 1e-9) + 1e-6

    # cells in the order of their distance to the first pivot, filled into groups; a large cell is split
    first = np.zeros(len(p), np.int64)
    parts = np.ones(len(p), np.int64)
    group_cells: dict[int, list[int]] = {}
    group, held = -1, query_rows
    for i in np.argsort(between[0, ids], kind="stable"):
        n = int(counts["n"].iloc[i])
        split = -(-n // query_rows)
        if split > 1 or held + n > query_rows:
            group += 1
            held = 0
        first[ids[i]], parts[ids[i]] = group, split
        for g in range(group, group + split):
            group_cells.setdefault(g, []).append(i)
        group += split - 1
        held = query_rows if split > 1 else held + n
    blocks = max(1, math.ceil((n_data or 0) / data_rows))

    def to_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = matrix(pdf["vec"], width)
            d = _distances(x, _lifted(x, most), p, p_lift)
            for g, members in group_cells.items():
                need = (d[:, ids[members]] <= reach[members]).any(1)
                if need.any():
                    yield pdf[need].assign(grp=np.int32(g))

    hashed = F.abs(F.xxhash64("id") % blocks).cast("int")
    spread = data.mapInPandas(to_groups, "id long, vec array<double>, grp int").withColumn("block", hashed)
    place = F.array(*[F.lit(int(v)) for v in first])[F.col("cell")] + (
        F.abs(F.xxhash64("id", F.lit("part"))) % F.array(*[F.lit(int(v)) for v in parts])[F.col("cell")]
    ).cast("int")
    asking = in_cells.select(
        "id", "vec", F.xxhash64("vec").alias("same"), place.cast("int").alias("grp"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("id", kind="stable")
        q_ids, x_ids = q["id"].to_numpy(), x["id"].to_numpy()
        x_vec = matrix(x["vec"], width)
        found = []
        for at in range(0, len(q), 512):
            part = slice(at, at + 512)
            s = _scores(matrix(q["vec"].iloc[part], width), x_vec)
            own = q_ids[part, None] == x_ids[None, :]
            for i in range(len(s)):
                keep = np.flatnonzero(~own[i])
                if len(keep) > k:
                    cut = np.partition(s[i, keep], len(keep) - k)[len(keep) - k]
                    above, level = keep[s[i, keep] > cut], keep[s[i, keep] == cut]
                    keep = np.concatenate([above, level[: k - len(above)]])
                found.append(pd.DataFrame({"query_id": q_ids[at + i], "same": q["same"].iloc[at + i], "vec_id": x_ids[keep], "score": s[i, keep]}))
        return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "same", "vec_id", "score")})

    keys = ["grp", "block"]
    local = asking.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(
        solve, "query_id long, same long, vec_id long, score long")
    best = Window.partitionBy("query_id", "same").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
