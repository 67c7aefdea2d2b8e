"""Exact top-k inner products by a Voronoi join.

Vectors are grouped by their nearest pivot. For a query q and a vector x of the cell of pivot p,
|q.x - q.p| <= |q| |x - p|, so a cell's smallest and largest distances to its pivot bound the scores it can give.
The summaries of all cells tell a score that a query's k-th best is sure to reach; the query goes only to cells that
can reach it. Cells are split in blocks and queries in chunks of bounded size, and each pair is solved on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rimstone.llm.common import materialize


PIVOTS = 24
BLOCK_ROWS = 4096  # about as many vectors of a cell are searched by one task at a time
CHUNK_QUERIES = 8192


def whole_vectors(vectors: DataFrame, scale: int = 1024, each: bool = False) -> DataFrame:
    """vec_id and `x` = floor(scale * component). Rows with a null or non-finite component, or without id, go.

    A vec_id counts once, with the smallest of its vectors; with `each`, every row counts.
    """
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    ints = F.transform(value, lambda v: F.floor(v * scale).cast("long"))
    usable = vectors.where(F.col("vec_id").isNotNull() & value.isNotNull() & (F.size(value) > 0) & finite)
    rows = usable.select("vec_id", ints.alias("x"))
    return rows if each else rows.groupBy("vec_id").agg(F.min("x").alias("x"))


def matrix(column, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which add nothing to an inner product."""
    out = np.zeros((len(column), width), np.int64)
    for i, row in enumerate(column):
        out[i, : len(row)] = row
    return out


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    gap = (x.astype(float) ** 2).sum(1)[:, None] - 2.0 * x @ pivots.T.astype(float) + (pivots.astype(float) ** 2).sum(1)
    return np.sqrt(np.maximum(gap, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where every sum is sure to be a whole number below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return np.rint(a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids, without the query itself."""
    if len(scores) > k + 1:
        floor = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        places = np.flatnonzero(scores >= floor)
    else:
        places = np.arange(len(scores))
    places = places[ids[places] != own]
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector for which `is_query` holds, its k largest inner products.

    Ties go to the smaller vec_id; a query with fewer than k other vectors gets all. `vectors` has vec_id and `x`
    (see `whole_vectors`). Rows that share a vec_id are candidates each, but not of queries of that id, and those are
    one query, with the best of all its rows' products. Empty input gives no rows. On the driver: the pivots and, for each, k + 1 distances and two
    numbers.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    chosen = vectors.orderBy(F.xxhash64("x"), "vec_id").limit(PIVOTS).collect()
    if not chosen:
        return spark.createDataFrame([], schema)
    width = vectors.agg(F.max(F.size("x"))).first()[0]
    pivots = np.unique(matrix([r["x"] for r in chosen], width), axis=0)

    def into_cells(batches) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33  # a number for each row, so that those of one id can be dealt out
        for batch in batches:
            gaps = distances(matrix(batch["x"].to_pylist(), width), pivots)
            cells = gaps.argmin(axis=1)
            named = {"vec_id": batch["vec_id"], "x": batch["x"], "cell": pa.array(cells.astype(np.int32))}
            named["row"] = pa.array(np.arange(row, row + len(cells)))
            row += len(cells)
            yield pa.RecordBatch.from_pydict(named | {"gap": pa.array(gaps[np.arange(len(cells)), cells])})

    schema_of_cells = "vec_id long, x array<long>, cell int, row long, gap double"
    placed = materialize(vectors.mapInArrow(into_cells, schema_of_cells), "cells")
    sizes = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("gap").alias("far")).collect()}
    nearest = Window.partitionBy("cell").orderBy("gap")
    by_id = placed.groupBy("cell", "vec_id").agg(F.min("gap").alias("gap"))
    ranked = by_id.withColumn("rn", F.row_number().over(nearest)).where(F.col("rn") <= k + 1)
    near: dict[int, list[tuple[float, int]]] = {}
    for r in ranked.collect():  # at most k + 1 of each cell
        near.setdefault(r["cell"], []).append((r["gap"], r["vec_id"]))

    queries = placed.where(is_query)
    n_chunks = max(1, -(-queries.count() // CHUNK_QUERIES))
    blocks = {c: max(1, -(-n // BLOCK_ROWS)) for c, (n, _) in sizes.items()}

    def send(batches) -> Iterator[pa.RecordBatch]:
        """Each query, once for each block of each cell that may hold one of its k best."""
        cells = np.array(sorted(sizes))
        far = np.array([sizes[c][1] for c in cells])
        gaps = np.array([g for c in cells for g, _ in near[c]])
        named = np.array([i for c in cells for _, i in near[c]])
        owner = np.array([i for i, c in enumerate(cells) for _ in near[c]])
        for batch in batches:
            x = matrix(batch["x"].to_pylist(), width)
            to_pivot = products(x, pivots[cells]).astype(float)
            norm = np.sqrt((x.astype(float) ** 2).sum(1))[:, None]
            sure = to_pivot[:, owner] - norm * gaps  # scores that a vector of the summaries reaches at least
            # The query's own vectors do not count; of each cell k other ids are left, if it has them.
            sure[np.array(batch["vec_id"].to_pylist())[:, None] == named] = -np.inf
            reach = np.sort(sure, axis=1)[:, -k] if sure.shape[1] >= k else np.full(len(x), -np.inf)
            slack = 1e-6 * (1 + np.abs(to_pivot) + norm * far)  # for rounding
            needed = to_pivot + norm * far + slack >= reach[:, None]
            for i, vec_id in enumerate(batch["vec_id"].to_pylist()):
                to = [(int(c), b) for c in cells[needed[i]] for b in range(blocks[int(c)])]
                columns = {
                    "query_id": pa.array([vec_id] * len(to), pa.int64()),
                    "q": pa.array([x[i].tolist()] * len(to), pa.list_(pa.int64())),
                    "cell": pa.array([c for c, _ in to], pa.int32()), "block": pa.array([b for _, b in to], pa.int32()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    sent = queries.select("vec_id", "x").mapInArrow(send, "query_id long, q array<long>, cell int, block int")
    sent = sent.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(n_chunks)).cast("int"))
    n_blocks = F.element_at(F.create_map(*[F.lit(int(v)) for item in blocks.items() for v in item]), F.col("cell"))
    block = F.pmod(F.xxhash64("row"), n_blocks).cast("int")
    data = placed.select("vec_id", "x", "cell", block.alias("block"))
    data = data.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))

    def solve(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asked):
            x, ids = matrix(own["x"], width), own["vec_id"].to_numpy()
            for at in range(0, len(asked), 512):
                part = asked.iloc[at : at + 512]
                scores = products(matrix(part["q"], width), x)
                for query, row in zip(part["query_id"].to_numpy(), scores, strict=True):
                    best = best_of(row, ids, query, k)
                    found.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": row[best]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    key = ["cell", "block", "chunk"]
    local = data.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
