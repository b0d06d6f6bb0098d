"""N-gram Jaccard join by vertical partitioning, and the components of its links.

The set of a document is its distinct ``width``-word shingles. Two documents link if 100 * |intersection| >= percent *
|union|. The join runs in these steps:

1. Chunks of documents exchange packed shingle hashes (`cells`) and learn which shingles another document holds too. A
   document with a link shares at least ``percent`` of its shingles, so most documents drop out here.
2. Documents with equal sets form a class, represented by its smallest identifier; only representatives go on.
3. A representative's *prefix* is its rarest shingles, so many that two linked sets must share one of them. Each posting
   list of a prefix shingle proposes pairs of its members with one leader; linked pairs join components, and later rounds
   propose pairs of different components only. So a list of thousands of near copies costs pairs in proportion to its
   length. What still lies in different components after the last leader is compared pair by pair, filtered by length.
4. The global order of n-grams (that of their hashes) is cut into fragments. The overlap of a pair is counted in each
   fragment by itself, from the two sets' segments there, and summed per pair.

Hashes have 64 bits and set digests 128; different shingles are taken as equal only if their hashes are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.lineage import written
from plumbline.llm import cells
from plumbline.llm.components import components

SETS = "doc_id long, n_shingles long, digest binary, shared binary"
#: Which members lead, round by round.
LEADERS = (("min({0})",), ("max({0})", "min_by({0}, hash(rep))"))
FRAGMENTS = 2
#: Of the intermediate tables, which make up a good part of the disk that the join needs.
CODEC = "zstd"


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Ascending distinct hashes of the shingles; a shorter text is one shingle of its own kind."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = cells.word_hashes(words)
    if len(words) < width:
        return cells.window_hashes(hashes, len(words)) ^ np.uint64(len(words) * 0x1234567887654321 % (1 << 64))
    return np.unique(cells.window_hashes(hashes, width))


class _Sets:
    """The shingle sets of a chunk; of equal sets, only the one with the smallest identifier takes part."""

    def __init__(self, table: pa.Table, width: int):
        table = table.sort_by([("doc_id", "ascending")])
        self.ids = table["doc_id"].to_pylist()
        self.sets = [shingle_set((t or b"").lower().split(), width) for t in table["text"].cast(pa.binary()).to_pylist()]
        self.digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in self.sets]
        seen, self.first = set(), []
        for k, (i, digest) in enumerate(zip(self.ids, self.digests, strict=True)):
            if i is not None and len(self.sets[k]) and digest not in seen:
                seen.add(digest)
                self.first.append(k)
        taken = [self.sets[k] for k in self.first]
        self.distinct, counts = np.unique(np.concatenate(taken) if taken else np.zeros(0, np.uint64), return_counts=True)
        self.several = counts > 1


def _send(width: int, buckets: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        s = _Sets(table, width)
        return cells.cells(key[0].as_py(), s.distinct, s.several.astype(np.uint64), buckets)

    return send


def _judge(table: pa.Table) -> pa.Table:
    """Bits for shingles that two sets hold."""
    hashes, several, lengths = cells.gathered(table)
    order = np.argsort(hashes, kind="stable")
    runs = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
    sizes = np.diff(runs, append=len(order))
    shared = np.empty(len(order), bool)
    shared[order] = np.repeat((sizes > 1) | (np.add.reduceat(several[order], runs) > 0), sizes)
    return cells.flagged(table, shared, lengths)


def _keep(width: int, buckets: int, percent: int):
    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        s = _Sets(left, width)
        shared = cells.flags_of(right, s.distinct, buckets)
        blobs: list[bytes | None] = [None] * len(s.ids)
        for k in s.first:
            own = s.sets[k]
            own = own[shared[np.searchsorted(s.distinct, own)]]
            if 100 * len(own) >= percent * len(s.sets[k]):
                blobs[k] = own.tobytes()
        return pa.table(
            {
                "doc_id": pa.array(s.ids, pa.int64()),
                "n_shingles": pa.array([len(x) for x in s.sets], pa.int64()),
                "digest": pa.array(s.digests, pa.binary()),
                "shared": pa.array(blobs, pa.binary()),
            }
        )

    return keep


def _tokens(batches):
    for batch in batches:
        blobs = [np.frombuffer(b, np.int64) for b in batch["shared"].to_pylist()]
        lengths = [len(b) for b in blobs]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(batch["rep"].to_numpy(), lengths), pa.int64()),
                pa.array(np.repeat(batch["n"].to_numpy(), lengths), pa.int64()),
                pa.array(np.concatenate(blobs) if blobs else np.zeros(0, np.int64), pa.int64()),
            ],
            names=["rep", "n", "h"],
        )


def _segments(fragments: int):
    """Each set's hashes (ascending as unsigned numbers) by fragment of the global order."""

    def segments(batches):
        for batch in batches:
            out = {"rep": [], "fragment": [], "segment": []}
            for rep, blob in zip(batch["rep"].to_pylist(), batch["shared"].to_pylist(), strict=True):
                hashes = np.frombuffer(blob, np.uint64)
                at = cells.cuts(hashes, fragments)
                for k in range(fragments):
                    out["rep"].append(rep)
                    out["fragment"].append(k)
                    out["segment"].append(hashes[at[k] : at[k + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out["rep"], pa.int64()), pa.array(out["fragment"], pa.int32()), pa.array(out["segment"], pa.binary())], names=list(out))

    return segments


def _overlaps(batches):
    """The partial overlap of each pair in a fragment."""
    for batch in batches:
        got = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(batch["left"].to_pylist(), batch["right"].to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(got, pa.int64())], names=["a", "b", "partial"])


def _linked(pairs: DataFrame, segments: DataFrame, lengths: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: overlaps are counted per fragment and summed."""
    left = segments.select(F.col("rep").alias("a"), "fragment", F.col("segment").alias("left"))
    right = segments.select(F.col("rep").alias("b"), "fragment", F.col("segment").alias("right"))
    partial = pairs.join(right, "b").join(left, ["a", "fragment"]).select("a", "b", "left", "right").mapInArrow(_overlaps, "a long, b long, partial long")
    total = partial.groupBy("a", "b").agg(F.sum("partial").alias("both"))
    sized = total.join(lengths.select(F.col("rep").alias("a"), F.col("n").alias("na")), "a").join(lengths.select(F.col("rep").alias("b"), F.col("n").alias("nb")), "b")
    return sized.where(f"100 * both >= {percent} * (na + nb - both)").select("a", "b")


def shingle_sets(documents: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, a digest of the set, and the shingles that other sets hold too, where they may be enough to link."""
    chunks, buckets = cells.sizes(documents, text_column)
    dealt = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    dealt = dealt.withColumn("chunk", cells.chunk_of(chunks, "doc_id", "text"))
    flags = dealt.groupBy("chunk").applyInArrow(_send(width, buckets), cells.CELL_SCHEMA).groupBy("bucket").applyInArrow(_judge, cells.FLAG_SCHEMA)
    return dealt.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(_keep(width, buckets, percent), SETS)


def _led(postings: DataFrame, leaders: tuple[str, ...]) -> DataFrame:
    """Pairs of members of a posting list with its leaders, if they lie in different components."""
    member = "struct(rep, n, component, at)"
    chosen = [F.expr(x.format(member)) for x in leaders]
    split = postings.groupBy("h").agg(F.array_distinct(F.array(*chosen)).alias("leads"), F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    met = postings.join(split.select("h", "leads"), "h").select("rep", "n", "component", "at", F.explode("leads").alias("lead")).where("component <> lead.component")
    room = F.least(F.col("n") - F.col("at"), F.col("lead.n") - F.col("lead.at")).alias("room")
    return met.select(F.least("rep", "lead.rep").alias("a"), F.greatest("rep", "lead.rep").alias("b"), F.least("n", "lead.n").alias("s"), F.greatest("n", "lead.n").alias("l"), room)


def _remaining(postings: DataFrame) -> DataFrame:
    """All pairs of members of a posting list that lie in different components."""
    split = postings.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    rest = postings.join(split.select("h"), "h")
    one, other = (rest.select("h", F.col("rep").alias(r), F.col("n").alias(f"n{r}"), F.col("component").alias(f"c{r}"), F.col("at").alias(f"at{r}")) for r in "ab")
    room = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb")).alias("room")
    return one.join(other, "h").where("a < b AND ca <> cb").select("a", "b", F.least("na", "nb").alias("s"), F.greatest("na", "nb").alias("l"), room)


def class_components(sets: DataFrame, percent: int = 80, fragments: int = FRAGMENTS) -> DataFrame:
    """(rep, component) of the representatives of classes that may link: the smallest representative they reach."""
    held = sets.where("shared IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("shared").alias("shared"))
    held = written(held.select("rep", "n", "shared"), "classes", CODEC)
    tokens = held.mapInArrow(_tokens, "rep long, n long, h long")
    common = tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    rarest = Window.partitionBy("rep").orderBy("df", "h")
    ranked = tokens.join(common, "h").withColumn("at", F.row_number().over(rarest)).withColumn("m", F.count("*").over(Window.partitionBy("rep")))
    # shingles of one set only come before all others in the order from rare to frequent
    ranked = ranked.selectExpr("rep", "n", "h", "n - m + at AS at")
    postings = written(ranked.where(f"at <= n - ceil({percent} * n / 100) + 1"), "postings", CODEC)
    lengths = held.select("rep", "n")
    segments = held.mapInArrow(_segments(fragments), "rep long, fragment int, segment binary")
    label = lengths.select("rep", F.col("rep").alias("component"))
    for leaders in (*LEADERS, None):
        open_ = postings.join(label, "rep")
        pairs = _led(open_, leaders) if leaders else _remaining(open_)
        # the first shingle that two sets share leaves room for so many more; of several rows of a pair the widest counts
        enough = f"100 * s >= {percent} * l AND {100 + percent} * (room + 1) >= {percent} * (s + l)"
        pairs = written(pairs.where(enough).select("a", "b").distinct(), "pairs", CODEC)
        found = _linked(pairs, segments, lengths, percent)
        # links join components, of which there are fewer than classes
        found = found.join(label.select(F.col("rep").alias("a"), F.col("component").alias("ca")), "a").join(label.select(F.col("rep").alias("b"), F.col("component").alias("cb")), "b")
        joined = components(found.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        renamed = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))
        label = written(label.join(renamed, "component", "left").select("rep", F.coalesce("joined", "component").alias("component")), "labels", CODEC)
    return label


def link_components(documents: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest identifier reachable by links, itself included.

    One row per input row. Words are split at white space after lower-casing A-Z; a text with fewer words than ``width``
    is one shingle; a null or empty text has none and links with nothing. Rows that repeat an identifier are judged row
    by row. A row without an identifier links with nothing and has no component. Other columns are ignored.
    """
    sets = written(shingle_sets(documents, width, percent, id_column, text_column), "sets", CODEC)
    classes = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = classes.join(class_components(sets, percent), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    named = sets.select("doc_id", "n_shingles", F.when(F.expr("n_shingles > 0 AND doc_id IS NOT NULL"), F.col("digest")).alias("digest"))
    return named.join(classes, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
