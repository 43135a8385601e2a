"""Exact top-k search as a Voronoi kNN join: scores are integer inner products, the largest ones win.

Pivots split the space into cells; every vector belongs to the cell of its nearest pivot. A cell's summary is its number of
rows, its radius (largest distance to the pivot) and the distances of its k + 1 nearest rows. With |q.x - q.p| <= |q| |x - p|
the summaries alone give, for a query q,

* a score that k other rows are certain to reach: the (k + 1)-th largest of q.p - |q| d over the listed distances d, and
* the highest score that a cell can hold: q.p + |q| r.

A query is sent only to cells whose best possible score reaches the certain one. There it is solved by a matrix product
against the cell's rows; the cells' best k are merged. The smaller side, the queries, is what is replicated: rows of the data
table move once. Cells with many rows (a vector that a third of all rows share) are split into blocks by the hash of the id,
as are the queries of a block, so a task's memory does not follow the size of a cell.

Summaries, pivots and the sample that places the pivots are bounded (``MOST_PIVOTS``, ``SAMPLE``); they steer the work only.
Bounds are computed in doubles and widened by ``SLACK``, scores are exact integers.

Rules for odd rows: a vector that is null, or holds a null or a non-finite component, takes no part; missing trailing
components count as 0; equal rows (id and vector) are one row; a null id takes no part, as it can be neither asked for nor
returned; fewer than k other rows give fewer results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnspark.llm.tables import computed, small_batches, written

K = 5
SCALE = 256
ROWS_PER_PIVOT = 512
MOST_PIVOTS = 1024
SAMPLE = 8192
ROUNDS = 4
BLOCK = 1024
QUERY_BLOCK = 4096
SLACK = 1e-6
FOUND = "query_id long, query_key long, vec_id long, score long"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def pivots_of(sample: np.ndarray, number: int) -> np.ndarray:
    """``number`` centres of a bounded sample: spread first picks, then a few rounds of moving to the mean."""
    x = np.unique(sample, axis=0).astype(float)
    if len(x) <= number:
        return x
    centres = x[np.linspace(0, len(x) - 1, number).astype(int)].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=number)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre and the distance to it."""
    own = np.argmax(x @ centres.T - (centres**2).sum(1) / 2, axis=1)
    return own, np.sqrt(((x - centres[own]) ** 2).sum(1))


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: by floating point where no sum can leave its integers."""
    most = np.abs(a).max(initial=0) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _solved(queries: pd.DataFrame, rows: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    """Best k of one block for each of its queries, ties to the smaller id."""
    if not len(queries) or not len(rows):
        return pd.DataFrame([], columns=["query_id", "query_key", "vec_id", "score"])
    rows = rows.sort_values("id", kind="stable")
    ids, x = rows["id"].to_numpy(np.int64), matrix(list(rows["v"]), width)
    out = []
    for a in range(0, len(queries), 512):
        part = queries.iloc[a:a + 512]
        own, certain = part["id"].to_numpy(np.int64), part["certain"].to_numpy(float)
        scores = dot(matrix(list(part["v"]), width), x)
        open_ = (scores >= certain[:, None]) & (ids[None, :] != own[:, None])
        ranked = np.argsort(np.where(open_, -scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
        q = np.repeat(np.arange(len(part)), ranked.shape[1])
        at = ranked.ravel()
        ok = open_[q, at]
        q, at = q[ok], at[ok]
        out.append(pd.DataFrame({"query_id": own[q], "query_key": part["key"].to_numpy()[q], "vec_id": ids[at], "score": scores[q, at]}))
    return pd.concat(out, ignore_index=True)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` marks, the k other rows with the highest scores."""
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    v = F.col(f"`{vector_col}`")
    base = vectors.filter(usable(v) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), quantised(v, scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    base = base.groupBy("id", "v").agg(F.max("asked").alias("asked")).withColumn("key", F.xxhash64("id", "v"))
    base = written(base, "vectors")
    n, width = base.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    sample = [r[0] for r in base.select("v").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).collect()]
    number = min(max(n // ROWS_PER_PIVOT, 1), MOST_PIVOTS)
    centres = pivots_of(matrix(sample, width), number) if sample else np.zeros((1, width))

    def place(vs: list) -> list[list]:
        own, far = nearest(matrix(vs, width).astype(float), centres)
        return [own.tolist(), far.tolist()]

    cells = written(computed(base, [F.col("v")], place, "cell int, far double", ["id", "key", "v", "asked"]), "cells")
    sizes = {r["cell"]: (r["n"], r["far"]) for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    close = cells.select("cell", "far", F.row_number().over(W.partitionBy("cell").orderBy("far")).alias("r")).filter(F.col("r") <= k + 1).collect()
    listed = np.array([(r["cell"], r["far"]) for r in close]).reshape(-1, 2)
    have = np.array(sorted(sizes), int)
    radius = np.array([sizes[c][1] for c in have])
    blocks = {int(c): -(-sizes[c][0] // BLOCK) for c in have}

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            q = matrix(list(f["v"]), width).astype(float)
            size = np.sqrt((q**2).sum(1))
            at = q @ centres.T
            sure = at[:, listed[:, 0].astype(int)] - size[:, None] * listed[:, 1]
            # The query itself may be one of the listed rows, so the (k + 1)-th bound holds for k others.
            certain = (np.sort(sure, axis=1)[:, -(k + 1)] if sure.shape[1] > k else np.full(len(q), -np.inf))
            certain = certain - SLACK * (1 + np.abs(certain))
            best = at[:, have] + size[:, None] * radius
            i, j = np.nonzero(best + SLACK * (1 + np.abs(best)) >= certain[:, None])
            cell = have[j]
            times = np.array([blocks[c] for c in cell.tolist()], int)
            i, cell = np.repeat(i, times), np.repeat(cell, times)
            block = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
            for a in range(0, len(i), 4096):
                s = slice(a, a + 4096)
                yield pd.DataFrame({"id": f["id"].to_numpy()[i[s]], "key": f["key"].to_numpy()[i[s]], "v": f["v"].to_numpy()[i[s]],
                                    "certain": np.maximum(certain[i[s]], -1e300), "cell": cell[s], "block": block[s]})

    asked = cells.filter("asked")
    n_asked = asked.count()
    pieces = max(-(-n_asked // QUERY_BLOCK), 1)
    sent = asked.select("id", "key", "v").mapInPandas(ask, "id long, key long, v array<long>, certain double, cell int, block int")
    sent = sent.withColumn("piece", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(pieces)).cast("int"))
    count_of = F.element_at(F.create_map(*[F.lit(x) for c in blocks for x in (c, blocks[c])]), F.col("cell")) if blocks else F.lit(1)
    data = cells.select("id", "v", "cell", F.pmod(F.xxhash64("key", F.lit(2)), count_of).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"))

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _solved(left, right, k, width)

    unit = ["cell", "block", "piece"]
    found = sent.groupBy(*unit).cogroup(data.groupBy(*unit)).applyInPandas(solve, FOUND)
    order = W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.col("vec_id") % 50 == 0)
