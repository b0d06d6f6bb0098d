"""Exact top-k search by inner product with vector-approximation files.

Vectors are dealt into blocks; each block keeps, beside its exact integer vectors, a cell number of a few bits per
component. The blocks are written once. A task scans the cells of a block for upper bounds of a block of queries, then
reads exact vectors in the order of their bounds until the k-th result is certain: no bound left reaches the k-th exact
score. The best k of every block meet in one ranking per query. Query blocks have a fixed size and are sent to all tasks
one after the other, so vectors are not shuffled again.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.lineage import written

#: Bytes of the exact vectors of a query block, and vectors of a block.
QUERY_BYTES = 8 << 20
VECTOR_BLOCK = 2048
TILE = 256
CELL_BITS = 5
#: Bytes of exact vectors that one step reads.
GATHER_BYTES = 64 << 20

PACKED = "{0} int, dim int, {0}_ids binary, {0}_exact binary, {0}_cells binary, {0}_edges binary"


def scaled(embedding: str, scale: int = 64) -> Column:
    """floor(scale * x) of every component as an integer; null for vectors that are null or hold null or non-finite ones."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def quantise(exact: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers by component, and the 2**bits + 1 edges of each component; a value lies between its cell's edges."""
    edges = np.quantile(exact, np.linspace(0, 1, 2**bits + 1), axis=0, method="lower").T
    cells = np.stack([np.clip(np.searchsorted(e, v, side="right") - 1, 0, 2**bits - 1) for e, v in zip(edges, exact.T, strict=True)], axis=1)
    return cells.astype(np.uint8), np.ascontiguousarray(edges)


def _pack(name: str, bits: int | None):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        block, dim = (k.as_py() for k in key)
        exact = np.stack([v.values.to_numpy() for v in table["v"]]) if dim else np.zeros((len(table), 0), np.int64)
        cells, edges = quantise(exact, bits) if bits and dim else (np.zeros(0, np.uint8), np.zeros(0, np.int64))
        columns = {name: [block], "dim": [dim], f"{name}_ids": [table["vec_id"].to_numpy().tobytes()], f"{name}_exact": [exact.tobytes()]}
        columns |= {f"{name}_cells": [cells.tobytes()], f"{name}_edges": [edges.tobytes()]}
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(columns.items(), kinds, strict=True)})

    return pack


def _exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of query i with its vectors [i, :, :]; in doubles as long as those are exact."""
    return np.einsum("qd,qmd->qm", queries, vectors)


def _tile(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """(row of the query, vector's id, score) of the k best of a block for each query."""
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    bounds[query_ids[:, None] == ids[None, :]] = -np.inf
    order = np.argsort(-bounds, axis=1, kind="stable")
    bounds = np.take_along_axis(bounds, order, axis=1)
    n, rows, open_ = len(ids), [], np.arange(len(queries))
    read = min(n, 2 * k)
    while len(open_):
        left = []
        # many equal bounds can ask for much of a block, so as many queries at a time as fit
        for some in np.array_split(open_, max(1, math.ceil(len(open_) * read * vectors.shape[1] * 8 / GATHER_BYTES))):
            near = order[some, :read]
            scores = _exact_scores(queries[some], vectors[near])
            scores[bounds[some, :read] == -np.inf] = -np.inf
            best = np.lexsort((ids[near], -scores), axis=1)[:, :k]
            top = np.take_along_axis(scores, best, axis=1)
            # certain once the next bound lies under the k-th score; an equal bound could still hold a smaller identifier
            done = np.ones(len(some), bool) if read == n else bounds[some, read] < top[:, -1]
            for i in np.flatnonzero(done):
                real = top[i] > -np.inf
                rows.append((np.full(int(real.sum()), some[i]), ids[near[i, best[i]]][real], top[i][real]))
            left.append(some[~done])
        open_, read = np.concatenate(left), min(n, 2 * read)
    return rows


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of (query_id, vec_id, score) the k best of each query."""
    query, ids, scores = found
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    first = np.flatnonzero(np.diff(query, prepend=query[:1] - 1))
    rank = np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query)))
    return [c[rank < k] for c in (query, ids, scores)]


def _search(k: int):
    def search(batches):
        held, size = [np.zeros(0, np.int64)] * 3, 0
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                found = [held]
                for query, ids, scores in _searched(row, k):
                    found.append([query, ids, scores])
                held = [np.concatenate(c) for c in zip(*found, strict=True)]
                # the blocks of a task meet here, so that it sends k rows a query however many blocks it read
                if len(held[0]) > 2 * size:
                    held = _best(held, k)
                    size = max(len(held[0]), 1000)
        held = _best(held, k)
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in held], names=["query_id", "vec_id", "score"])

    return search


def _searched(r: dict, k: int):
    """(query_id, vec_id, score) of the k best of a block of vectors for a block of queries."""
    dim = r["dim"]
    qid, vid = (np.frombuffer(r[x], np.int64) for x in ("q_ids", "v_ids"))
    queries = np.frombuffer(r["q_exact"], np.int64).reshape(len(qid), dim)
    vectors = np.frombuffer(r["v_exact"], np.int64).reshape(len(vid), dim)
    exact = dim and dim * float(np.abs(queries).max()) * float(np.abs(vectors).max()) < 2.0**53
    if exact:
        queries, vectors = queries.astype(float), vectors.astype(float)
        cells = np.frombuffer(r["v_cells"], np.uint8).reshape(-1, dim)
        edges = np.frombuffer(r["v_edges"], np.int64).reshape(dim, -1).astype(float)
        low, high = edges[np.arange(dim), cells], edges[np.arange(dim), cells + 1]
    else:  # too large for exact doubles: whole numbers of any size, each vector its own cell
        queries, vectors = queries.astype(object), vectors.astype(object)
    for at in range(0, len(qid), TILE):
        if exact:
            rows = _tile(queries[at : at + TILE], qid[at : at + TILE], vectors, vid, low, high, k)
        else:
            rows = _plain(queries[at : at + TILE], qid[at : at + TILE], vectors, vid, k)
        for i, ids, scores in rows:
            if len(ids):
                yield qid[at:][i], ids, np.array([int(x) for x in scores], np.int64)


def _plain(queries, query_ids, vectors, ids, k):
    rows = []
    for i, q in enumerate(queries):
        scores = [(-sum(a * b for a, b in zip(q, v, strict=True)), j) for v, j in zip(vectors, ids, strict=True) if j != query_ids[i]]
        best = sorted(scores)[:k]
        rows.append((np.full(len(best), i), np.array([j for _, j in best], np.int64), np.array([-s for s, _ in best], object)))
    return rows


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", embedding_column: str = "embedding", scale: int = 64, bits: int = CELL_BITS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of every query with all other rows.

    Ties go to the smaller identifier. Vectors that are null or hold null or non-finite components, and rows without an
    identifier, take no part. Every row counts, also if its identifier repeats; a query is not compared with rows of its own
    identifier, and queries that share one share a ranking. Vectors of different lengths
    are not compared. Fewer than k candidates give as many rows; an empty table gives none. Scores must fit 64 bits.
    """
    chosen = vectors.select(F.col(id_column).cast("long").alias("vec_id"), scaled(embedding_column, scale).alias("v"), is_query.alias("asks"))
    chosen = chosen.where("vec_id IS NOT NULL AND v IS NOT NULL")
    # rows get a number when they are stored, so that equal identifiers spread over the blocks as well as others
    chosen = chosen.withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id())
    chosen = written(chosen, "vectors")
    count = vectors.agg(F.count("*").alias("n"), F.sum(F.when(is_query, 8 * F.size(embedding_column))).alias("q")).first()
    blocks, query_blocks = max(1, math.ceil(count["n"] / VECTOR_BLOCK)), max(1, math.ceil((count["q"] or 0) / QUERY_BYTES))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    packed = chosen.withColumn("v_", deal(blocks)).groupBy("v_", "dim").applyInArrow(_pack("v", bits), PACKED.format("v"))
    packed = written(packed, "va-file").select("dim", "v_ids", "v_exact", "v_cells", "v_edges")
    asked = chosen.where("asks").withColumn("q_", deal(query_blocks)).groupBy("q_", "dim").applyInArrow(_pack("q", None), PACKED.format("q"))
    asked = written(asked, "queries").select("q", "dim", "q_ids", "q_exact")
    met = [packed.join(F.broadcast(asked.where(F.col("q") == block)), "dim").mapInArrow(_search(k), "query_id long, vec_id long, score long") for block in range(query_blocks)]
    found = reduce(DataFrame.union, met)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
