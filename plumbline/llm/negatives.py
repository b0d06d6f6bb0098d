"""Hard negatives by angular triangle filtering.

Every vector keeps its angles to a few reference directions. By the triangle inequality on the sphere the angle between
two vectors lies between the largest difference and the least sum of their angles to one reference, which gives an
interval of their cosine and, times both norms and widened by more than any rounding, of their integer score. Only vectors
whose interval overlaps a window that an anchor still asks for are scored, in whole numbers.

Vectors are dealt into blocks by their nearest reference, so that a block has narrow ranges of angles and is often passed
over as a whole. Anchors come in blocks of a bounded size, and carry the best results so far, to all tasks. The vectors
are searched in rounds that grow eightfold: what an eighth of them has given is the bound that the rest has to reach, so
tasks return few rows. A first search finds the positives, whose scores are the windows of the second.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.lineage import ensure_checkpoint_dir, written
from plumbline.llm.vafile import scaled

REFERENCES = 8
#: Rows, of the smallest hashes, among which the reference directions are chosen.
SAMPLE_ROWS = 1024
VECTOR_BLOCK = 2048
ANCHOR_BYTES = 8 << 20
TILE = 64
GROWTH = 8
EMPTY = np.int64(-(2**63))
LAST = np.int64(2**63 - 1)
#: Relative width that no rounding of angles, cosines and norms reaches.
SLACK = 1e-6

_BLOCK = "dim int, u double, ids binary, labels binary, exact binary, norms binary, angles binary"
_ASKED = "q int, dim int, ids binary, labels binary, exact binary, norms binary, angles binary, lows binary, highs binary, best binary, names binary, positives binary"
_LISTED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = "q int, dim int, anchor int, slot int, vec_id long, score long"


def references(sample: np.ndarray, number: int = REFERENCES) -> np.ndarray:
    """Unit vectors of a sample, each the one farthest in angle from those before it."""
    norms = np.sqrt((sample**2).sum(axis=1))
    unit = sample[norms > 0] / norms[norms > 0, None]
    chosen: list[int] = []
    nearest = np.full(len(unit), -np.inf)
    while len(unit) and len(chosen) < number and (not chosen or nearest.min() < 1 - 1e-9):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions; those of a zero vector are a right angle and do not matter."""
    norms = np.sqrt((vectors**2).sum(axis=1))
    cosines = (vectors @ directions.T) / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(cosines, -1, 1))


def bounds(norms: np.ndarray, theirs: np.ndarray, other_norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers that no score of i and j lies under or over, from norms and angles to the same directions."""
    high, low = np.ones((len(norms), len(other_norms))), -np.ones((len(norms), len(other_norms)))
    for k in range(theirs.shape[1]):
        near = np.outer(np.cos(theirs[:, k]), np.cos(others[:, k]))
        far = np.outer(np.sin(theirs[:, k]), np.sin(others[:, k]))
        # cosines of the difference and of the sum; beyond a half turn the sum's cosine is that of what remains to a whole
        np.minimum(high, near + far, out=high)
        np.maximum(low, near - far, out=low)
    size = np.outer(norms, other_norms)
    slack = size * SLACK + 1
    return np.ceil(low * size - slack), np.floor(high * size + slack)


def block_bounds(norms: np.ndarray, theirs: np.ndarray, other_norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector i the same over all j."""
    if not theirs.shape[1]:
        most = norms * other_norms.max() * (1 + SLACK) + 1
        return -most, most
    first, last = others.min(axis=0), others.max(axis=0)
    gap = np.maximum(np.maximum(first - theirs, theirs - last), 0).max(axis=1)
    # the largest angle lies under the least of the sums, folded back beyond a half turn
    low_sum, high_sum = theirs + first, theirs + last
    wide = np.where(high_sum <= math.pi, high_sum, np.where(low_sum >= math.pi, 2 * math.pi - low_sum, math.pi)).min(axis=1)
    high, low = np.cos(gap), np.cos(wide)
    least, most = other_norms.min(), other_norms.max()
    slack = norms * most * SLACK + 1
    return norms * np.minimum(low * least, low * most) - slack, norms * np.maximum(high * least, high * most) + slack


class Anchors:
    """A block of anchors of one length with the windows they ask for and the best scores so far: anchors x windows x k."""

    def __init__(self, row: dict, windows: int, k: int):
        self.dim = row["dim"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        n = len(self.ids)
        self.exact = np.frombuffer(row["exact"], np.int64).reshape(n, self.dim)
        self.norms = np.frombuffer(row["norms"])
        self.angles = np.frombuffer(row["angles"]).reshape(n, -1)
        self.lows, self.highs = (np.frombuffer(row[c], np.int64).reshape(n, windows) for c in ("lows", "highs"))
        self.best, self.names = (np.frombuffer(row[c], np.int64).reshape(n, windows, k).copy() for c in ("best", "names"))
        self.fresh = np.zeros(self.best.shape, bool)
        self.most = int(np.abs(self.exact).max(initial=0))

    def needed(self, i=slice(None)) -> np.ndarray:
        """The least score that still matters, by window."""
        return np.maximum(self.lows[i], self.best[i, :, -1])

    def put(self, i: int, w: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Keep the k best of a window: higher scores first, ties by smaller identifier."""
        k = self.best.shape[2]
        scores, ids = np.concatenate([self.best[i, w], scores]), np.concatenate([self.names[i, w], ids])
        fresh = np.concatenate([self.fresh[i, w], np.ones(len(ids) - k, bool)])
        order = np.lexsort((ids, -np.maximum(scores, -LAST), scores == EMPTY))[:k]
        self.best[i, w], self.names[i, w], self.fresh[i, w] = scores[order], ids[order], fresh[order] & (scores[order] != EMPTY)


def search(anchors: Anchors, block: dict, same: bool) -> None:
    """Take what a block of vectors has for the anchors' windows, of the same or of other labels."""
    ids, labels, norms = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["labels"], np.int64), np.frombuffer(block["norms"])
    vectors = np.frombuffer(block["exact"], np.int64).reshape(len(ids), anchors.dim)
    theirs = np.frombuffer(block["angles"]).reshape(len(ids), -1)
    safe = anchors.dim * float(anchors.most) * float(np.abs(vectors).max(initial=0)) < 2.0**52
    if not safe:  # whole numbers of any size, without bounds
        return _plain(anchors, ids, labels, vectors, same)
    vectors, asking = vectors.astype(float), anchors.exact.astype(float)
    k = anchors.best.shape[2]
    least, most = block_bounds(anchors.norms, anchors.angles, norms, theirs)
    open_ = np.flatnonzero(((most[:, None] >= anchors.needed()) & (least[:, None] <= anchors.highs) & (anchors.lows <= anchors.highs)).any(axis=1))
    for at in range(0, len(open_), TILE):
        some = open_[at : at + TILE]
        low, high = bounds(anchors.norms[some], anchors.angles[some], norms, theirs)
        fits = (labels == anchors.labels[some, None]) if same else (labels != anchors.labels[some, None])
        fits &= ids != anchors.ids[some, None]
        for row, i in enumerate(some):
            fit = np.flatnonzero(fits[row])
            lo, hi = low[row, fit], high[row, fit]
            wanted, windows = np.zeros(len(fit), bool), []
            for w, (floor, first, last) in enumerate(zip(anchors.needed(i), anchors.lows[i], anchors.highs[i], strict=True)):
                if first > last:
                    continue
                sure = lo[(lo >= first) & (hi <= last)]
                if len(sure) >= k:
                    floor = max(floor, np.partition(sure, len(sure) - k)[len(sure) - k])
                overlap = (hi >= floor) & (lo <= last)
                wanted |= overlap
                windows.append((w, overlap))
            if not wanted.any():
                continue
            scores = np.zeros(len(fit), np.int64)
            scores[wanted] = (vectors[fit[wanted]] @ asking[i]).astype(np.int64)
            for w, overlap in windows:
                inside = np.flatnonzero(overlap & (scores >= anchors.needed(i)[w]) & (scores <= anchors.highs[i, w]))
                if len(inside):
                    anchors.put(i, w, scores[inside], ids[fit[inside]])


def _plain(anchors: Anchors, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, same: bool) -> None:
    columns = vectors.astype(object)
    for i, asking in enumerate(anchors.exact.astype(object)):
        fit = np.flatnonzero(((labels == anchors.labels[i]) == same) & (ids != anchors.ids[i]))
        scores = np.array([min(max(int(s), -int(LAST)), int(LAST)) for s in columns[fit] @ asking] if anchors.dim else [0] * len(fit), np.int64)
        for w in range(anchors.best.shape[1]):
            inside = (scores >= anchors.lows[i, w]) & (scores <= anchors.highs[i, w])
            anchors.put(i, w, scores[inside], ids[fit[inside]])


def _stacked(table: pa.Table, dim: int) -> np.ndarray:
    values = pc.list_flatten(table["v"]).to_numpy()
    return values.astype(np.int64).reshape(len(table), dim)


def _vectors(table: pa.Table, dim: int, directions: dict[int, np.ndarray]) -> dict[str, bytes]:
    exact = _stacked(table, dim)
    norms, turned = angles(exact.astype(float), directions.get(dim, np.zeros((0, dim))))
    return {"ids": table["vec_id"].to_numpy().tobytes(), "labels": table["label"].to_numpy().tobytes(), "exact": exact.tobytes(), "norms": norms.tobytes(), "angles": turned.tobytes()}


def _one(row: dict, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist([row], schema)


def _schema(columns: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _homes(directions: dict[int, np.ndarray]):
    """The number of the nearest reference of every vector."""

    def find(batches):
        for batch in batches:
            dims, homes = batch["dim"].to_numpy(), np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if len(directions.get(int(dim), ())):
                    part = _stacked(pa.Table.from_batches([batch]).take(pa.array(at)), int(dim)).astype(float)
                    homes[at] = angles(part, directions[int(dim)])[1].argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(homes)], names=[*batch.schema.names, "home"])

    return find


def _pack_block(directions: dict[int, np.ndarray]):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        # where a block stands in the rounds: spread evenly by its own numbers
        u = (key[1].as_py() * 0.7548776662466927 + key[2].as_py() * 0.5698402909980532 + 0.5) % 1.0
        return _one({"dim": dim, "u": u} | _vectors(table, dim, directions), _schema(_BLOCK))

    return pack


def _pack_anchors(directions: dict[int, np.ndarray], k: int):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        q, dim = (x.as_py() for x in key)
        n = len(table)
        windows = {"lows": np.full(n, EMPTY + 1), "highs": np.full(n, LAST), "best": np.full(n * k, EMPTY), "names": np.zeros(n * k, np.int64)}
        return _one({"q": q, "dim": dim, "positives": b""} | _vectors(table, dim, directions) | {c: v.tobytes() for c, v in windows.items()}, _schema(_ASKED))

    return pack


def _searched(windows: int, k: int, same: bool):
    schema = _schema(_FOUND)

    def run(batches):
        held: dict[tuple[int, int], Anchors] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                key = row["q"], row["dim"]
                if key not in held:
                    held[key] = Anchors({c.removeprefix("a_"): v for c, v in row.items() if c.startswith("a_") or c == "dim"}, windows, k)
                search(held[key], row, same)
        for (q, dim), anchors in held.items():
            i, w, r = np.nonzero(anchors.fresh)
            if len(i):
                columns = [np.full(len(i), q), np.full(len(i), dim), i, w, anchors.names[i, w, r], anchors.best[i, w, r]]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _merged(windows: int, k: int):
    def merge(asked: pa.Table, found: pa.Table) -> pa.Table:
        (row,) = asked.to_pylist()
        anchors = Anchors(row, windows, k)
        if len(found):
            i, w, ids, scores = (found[c].to_numpy() for c in ("anchor", "slot", "vec_id", "score"))
            order = np.lexsort((w, i))
            edges = np.flatnonzero(np.diff(i[order] * np.int64(windows) + w[order], prepend=-1))
            for part in np.split(order, edges[1:]):
                anchors.put(int(i[part[0]]), int(w[part[0]]), scores[part], ids[part])
        return _one(row | {"best": anchors.best.tobytes(), "names": anchors.names.tobytes()}, asked.schema)

    return merge


def window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The scores s with low * positive <= 100 * s <= high * positive, first and last."""
    hundreds, rest = positive // 100, positive % 100
    return low * hundreds - (-low * rest) // 100, high * hundreds + (high * rest) // 100


def _turned(k: int, then: int, low: int, high: int):
    """Anchors that have their positives ask for negatives."""

    def turn(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                anchors = Anchors(row, 1, k)
                scores, ids = anchors.best[:, 0], anchors.names[:, 0]
                real = scores != EMPTY
                first, last = window(np.where(real, scores, 0), low, high)
                row["lows"], row["highs"] = np.where(real, first, LAST).tobytes(), np.where(real, last, EMPTY).tobytes()
                row["positives"] = np.stack([ids, scores]).tobytes()
                row["best"], row["names"] = np.full(scores.size * then, EMPTY).tobytes(), np.zeros(scores.size * then, np.int64).tobytes()
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, batch.schema)

    return turn


def _listed(windows: int, k: int):
    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                anchors = Anchors(row, windows, k)
                positives = np.frombuffer(row["positives"], np.int64).reshape(2, len(anchors.ids), windows)
                i, w, r = np.nonzero(anchors.best != EMPTY)
                columns = [anchors.ids[i], positives[0, i, w], (r + 1).astype(np.int32), anchors.names[i, w, r], positives[1, i, w], anchors.best[i, w, r]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _LISTED.split(", ")])

    return unpack


def _rounds(blocks: DataFrame, asked: DataFrame, number: int, queries: int, windows: int, k: int, same: bool) -> DataFrame:
    """Anchors with the best results of all vectors, searched in rounds of 1, 7, 56, ... parts."""
    spark, edges = blocks.sparkSession, [0.0]
    for level in range(max(0, math.ceil(math.log(max(1, number), GROWTH))) - 1, -1, -1):
        edges.append(GROWTH**-level)
    if len(edges) == 1:
        edges.append(1.0)
    carried = ["ids", "labels", "exact", "norms", "angles", "lows", "highs", "best", "names"]
    for start, end in zip(edges, edges[1:], strict=False):
        folder = f"{ensure_checkpoint_dir(spark)}/found-{uuid.uuid4().hex}"
        part = blocks.where((F.col("u") >= start) & (F.col("u") < end))
        sent = asked.select("q", "dim", *[F.col(c).alias(f"a_{c}") for c in carried])
        for q in range(queries):
            met = part.join(F.broadcast(sent.where(F.col("q") == q)), "dim").mapInArrow(_searched(windows, k, same), _FOUND)
            met.write.mode("append").parquet(folder)
        found = spark.read.schema(_FOUND).parquet(folder)
        asked = written(asked.groupBy("q", "dim").cogroup(found.groupBy("q", "dim")).applyInArrow(_merged(windows, k), _ASKED), "anchors")
    return asked


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, id_column: str = "vec_id", label_column: str = "label", embedding_column: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    A score is the inner product of floor(scale * x) of all components; higher ones come first, ties by smaller
    identifier. The first ``positives`` other rows with the anchor's label are its positives; for each of these the first
    ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score follow.
    A positive without negatives gives no row.

    Rows with a null identifier or label, a null vector, or a null or non-finite component take no part. Every row counts
    by itself, also if its identifier or vector repeats, but no row is a positive or negative of an anchor with its own
    identifier; an anchor's row that repeats gives its rows again. Vectors of different lengths are not compared, empty
    ones score 0. Scores beyond 64 bits count as the farthest number. An empty table, or one without anchors, gives no
    rows. References are chosen among the 1,024 rows with the smallest hashes; all rows are searched.
    """
    named = lambda c: F.col(f"`{c}`")
    chosen = vectors.select(named(id_column).cast("long").alias("vec_id"), named(label_column).cast("long").alias("label"), scaled(f"`{embedding_column}`", scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    chosen = chosen.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
    sample: dict[int, list] = {}
    for r in chosen.select("dim", "v").orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE_ROWS).collect():
        sample.setdefault(r["dim"], []).append(r["v"])
    directions = {dim: references(np.array(rows, float).reshape(len(rows), dim)) for dim, rows in sample.items()}
    schema = T.StructType([*chosen.schema.fields, T.StructField("home", T.IntegerType())])
    # rows get a number when they are stored, so that equal identifiers spread as well as others
    rows = written(chosen.mapInArrow(_homes(directions), schema).withColumn("row", F.monotonically_increasing_id()), "vectors")
    homes = rows.groupBy("dim", "home").agg(F.ceil(F.count("*") / VECTOR_BLOCK).alias("parts"))
    total = homes.agg(F.sum("parts")).first()[0] or 0
    size = rows.where("asks").agg(F.sum(8 * F.greatest("dim", F.lit(1)))).first()[0] or 0
    queries = math.ceil(size / ANCHOR_BYTES)
    if not queries:
        return vectors.sparkSession.createDataFrame([], _LISTED)
    dealt = rows.join(homes, ["dim", "home"]).withColumn("part", F.pmod(F.col("row"), F.col("parts")).cast("int"))
    blocks = written(dealt.groupBy("dim", "home", "part").applyInArrow(_pack_block(directions), _BLOCK), "blocks")
    asked = rows.where("asks").withColumn("q", F.pmod(F.xxhash64("row"), F.lit(queries)).cast("int"))
    asked = written(asked.groupBy("q", "dim").applyInArrow(_pack_anchors(directions, positives), _ASKED), "anchors")
    asked = _rounds(blocks, asked, total, queries, 1, positives, True)
    asked = asked.mapInArrow(_turned(positives, negatives, low, high), _ASKED)
    asked = _rounds(blocks, written(asked, "anchors"), total, queries, positives, negatives, False)
    return asked.mapInArrow(_listed(positives, negatives), _LISTED)
