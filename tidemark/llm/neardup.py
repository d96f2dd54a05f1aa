"""Near-duplicate classes by DartMinHash signatures.

A document is the multiset of its five-word shingles (fewer words: one shingle); similarity is
the weighted Jaccard index.  Darts are thrown by hash at the plane of element weight and rank:
every unit cell of an element's weight and of the rank holds a Poisson number of them, each with
a rank and a coordinate.  A document keeps, for every coordinate, the earliest dart in the region
under its weights.  Ranks up to k ln k + 2k over the document's weight fill nearly all
coordinates, so a document of n shingles costs about max(n, that) darts; the limit doubles until
all are filled.  Two documents agree in a coordinate with probability equal to their similarity.

1.  Texts that agree after case and white space are one node, with one signature.
2.  The first coordinates form bands; nodes that share a band meet in its bucket.
3.  Every member of a bucket is compared, on its shingles, with the bucket's most popular member
    (the one that shares most bands with others, the likely original): linear in the bucket.
4.  Links of ``threshold`` or more give components, by label propagation with pointer jumping.
5.  Buckets that still hold two components are compared between components, in blocks of bounded
    size, by signature first and at once on the shingles, which the members bring along; a pair is taken
    in the first band that it shares.  A block joins components as it finds links and sends only those
    that join two, fewer than it has members.  So no link is lost to step 3, and no pairs are sent.

With 24 bands of 4 a pair of similarity 0.8 misses every bucket with probability 3e-6; a pair is
passed over in step 5 for its signature with probability 2e-4, at 0.8 exactly.

Defined cases: a null text is empty; texts without words are one class; repeated rows are in one
class; the class id is the smallest ``doc_id`` in it (null if it has none); an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, join_counted, join_null_safe, ship_by_value, stage, text_of

ship_by_value(__name__)


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    coordinates: int = 256
    bands: int = 24
    rows: int = 4
    block: int = 256
    #: signatures this many standard deviations under the threshold are still compared
    deviations: float = 3.5


_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
#: cumulated probabilities of 0, 1, 2, ... darts in a cell, as thresholds of 32-bit hashes
_POISSON = np.floor(np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, i + 1, dtype=float)) for i in range(12)]) * 2**32).astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_known: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2 ** 64; a task keeps the longest list that it needed."""
    if base not in _known or len(_known[base]) < n:
        out = np.full(max(n, 4096), _U(base & (2**64 - 1)))
        out[0] = 1
        _known[base] = np.multiply.accumulate(out)
    return _known[base][:n]


def cells(text: str, words: int = 5) -> np.ndarray:
    """Sorted hashes of (shingle, number of its occurrence): unit cells of the elements' weights.

    ``text`` has single blanks between words.  Shingles are hashed as substrings, by differences
    of one running polynomial hash of the bytes.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    powers = _powers(_BASE, len(data) + 1)
    running = np.concatenate([[_U(0)], np.add.accumulate((data.astype(np.uint64) + _U(1)) * powers[:-1])])
    blanks = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(data)]])
    if len(starts) > words:
        starts, ends = starts[: -(words - 1)], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    back = _powers(_INVERSE, len(data) + 1)
    shingles = np.sort(_mixed((running[ends] - running[starts]) * back[starts]))
    new = np.concatenate([[True], shingles[1:] != shingles[:-1]])
    number = np.arange(len(shingles)) - np.maximum.accumulate(np.where(new, np.arange(len(shingles)), 0))
    return np.sort(_mixed(shingles + number.astype(np.uint64) * _ODD))


#: bits of a rank after the point; those before it, and 8 of the coordinate, fill the word
_FRACTION = 40


def signature(unit: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of every coordinate (256 at most), as a 64-bit hash."""
    limit = k * (np.log(k) + 2) / len(unit)
    while True:
        ranks = np.arange(int(np.ceil(limit)), dtype=np.uint64)
        grid = _mixed(unit[:, None] + (ranks[None, :] + _U(1)) * _U(0xD6E8FEB86659FD93)).ravel()
        darts = np.searchsorted(_POISSON, grid >> _U(32), side="right")
        which = np.repeat(np.arange(len(grid)), darts)
        order = np.arange(len(which)) - (np.cumsum(darts) - darts)[which]
        dart = _mixed(grid[which] + (order.astype(np.uint64) + _U(1)) * _ODD)
        # the rank as a fixed-point number; equal ranks are equal darts, so it also names the dart
        rank = ((which % len(ranks)).astype(np.uint64) << _U(_FRACTION)) | (dart >> _U(64 - _FRACTION))
        early = rank < _U(int(limit * 2**_FRACTION))
        dart, rank = dart[early], rank[early]
        keyed = np.sort(((dart & _U(0xFFFFFFFF)) % _U(k) << _U(56)) | rank)
        at = keyed >> _U(56)
        first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        if len(first) == k:
            return _mixed(keyed[first])
        limit *= 2


def bands(sig: np.ndarray, settings: Settings) -> np.ndarray:
    part = sig[: settings.bands * settings.rows].reshape(settings.bands, settings.rows)
    out = np.arange(settings.bands, dtype=np.uint64) * _U(0xA0761D6478BD642F)
    for i in range(settings.rows):
        out = _mixed(out + part[:, i])
    return out.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard index of two documents' cells."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def normal(text: Column) -> Column:
    """Lower case, single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def _signed(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, sigs = [], []
            for value in batch.column("text"):
                unit = cells(value.as_py(), settings.words)
                sig = signature(unit, settings.coordinates) if len(unit) else None
                marks.append([] if sig is None else bands(sig, settings))
                sigs.append(b"" if sig is None else sig.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(marks, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], ["doc_id", "node", "bands", "sig"])
    return run


def _texts(docs: DataFrame) -> DataFrame:
    plain = documents(docs).select("doc_id", normal(F.col("text")).alias("text"))
    return plain.select("doc_id", F.unhex(F.md5("text")).alias("node"), "text")


def signatures(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, node, bands, sig`` for every row."""
    work = _texts(docs)
    return work.mapInArrow(_signed(settings), f"doc_id {work.schema['doc_id'].dataType.simpleString()}, node binary, bands array<bigint>, sig binary")


def _compared(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for left, right, other in zip(batch.column("text"), batch.column("other_text"), batch.column("b"), strict=True):
                node = other.as_py()
                if last[0] != node:
                    last = (node, cells(right.as_py(), settings.words))
                keep.append(similarity(cells(left.as_py(), settings.words), last[1]) >= settings.threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def linked(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """The staged pairs (a, b) of nodes whose similarity, on their whole texts, reaches the threshold."""
    nodes = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    found = join_counted(_texts(docs).select("node", "text"), nodes, ["node"], "left_semi")
    texts = stage(found.groupBy("node").agg(F.first("text").alias("text")))
    left = pairs.join(texts.withColumnRenamed("node", "a"), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("other_text")), "b")
    return stage(both.select("a", "b", "text", "other_text").mapInArrow(_compared(settings), "a binary, b binary"))


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of all nodes with a link: the smallest node of the component; staged."""
    edges = stage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m")).select("node", F.least("node", "_m").alias("label")))
    while True:
        heard = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_m"))
        lower = stage(labels.join(heard, "node").select("node", F.col("label").alias("_old"), F.least("label", "_m").alias("label")))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        after = stage(lower.join(jump, "label").select("node", F.col("_next").alias("label"), (F.col("_old") != F.col("_next")).alias("_changed")))
        labels = after.select("node", "label")
        if after.where("_changed").isEmpty():
            return labels


def _celled(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cells(t.as_py(), settings.words).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "cells"])
    return run


def _blocks(settings: Settings):
    """Compares the members of sorted (bucket, i, j) groups between components: links that join two."""
    least = settings.coordinates * settings.threshold - settings.deviations * np.sqrt(settings.coordinates * settings.threshold * (1 - settings.threshold))

    def pairs(group: pd.DataFrame) -> Iterator[tuple[bytes, bytes]]:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        mine = group["own"].to_numpy()
        label = pd.factorize(group["label"])[0]
        marks = np.stack(group["bands"].to_list())
        sig = np.frombuffer(b"".join(group["sig"]), np.uint8).reshape(len(group), -1)
        at = int(np.flatnonzero(marks[0] == group["bucket"].iloc[0])[0])
        nodes = group["node"].to_list()
        units = [np.frombuffer(c, np.uint64) for c in group["cells"]]
        for p in range(len(group) - 1):
            rest = np.arange(p + 1, len(group))
            rest = rest[(label[rest] != label[p]) & ((mine[rest] != mine[p]) if i != j else True)]
            if len(rest):
                rest = rest[~(marks[rest, :at] == marks[p, :at]).any(axis=1)]
                rest = rest[(sig[rest] == sig[p]).sum(axis=1) >= least]
            for q in rest:
                if label[q] != label[p] and similarity(units[p], units[q]) >= settings.threshold:
                    label[label == label[q]] = label[p]
                    yield nodes[p], nodes[q]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            keys = frame[["bucket", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist()]
            out = [x for a, b in zip(edges, edges[1:], strict=False) for x in pairs(frame.iloc[a:b])]
            held = frame.iloc[edges[-1] :]
            yield pd.DataFrame(out, columns=["a", "b"])
        if held is not None and len(held):
            yield pd.DataFrame(list(pairs(held)), columns=["a", "b"])
    return run


def classes(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Staged (doc_id, node) by row and (node, label, class_id) by node."""
    rows = stage(signatures(docs, settings))
    nodes = stage(rows.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    marks = nodes.select("node", F.explode_outer("bands").alias("bucket")).where(F.col("bucket").isNotNull())
    shared = stage(marks.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = stage(join_counted(marks, shared, ["bucket"]))
    popular = stage(members.groupBy("node").agg(F.sum("n").alias("popularity")))
    ranked = members.join(popular, "node").select("bucket", F.struct("popularity", "node").alias("r"))
    heads = ranked.groupBy("bucket").agg(F.max("r").alias("r")).select("bucket", F.col("r.node").alias("b"))
    stars = stage(members.join(heads, "bucket").where("node != b").select(F.col("node").alias("a"), "b").distinct())
    labels = components(linked(stars, docs, settings))
    labelled = stage(members.join(labels, "node", "left").select("bucket", "node", "n", F.coalesce("label", "node").alias("label")))
    mixed = labelled.groupBy("bucket").agg((F.min("label") != F.max("label")).alias("_mixed")).where("_mixed").select("bucket")
    # what is left meets in blocks: every member with its own block and with each of the others
    parts = F.ceil(F.col("n") / settings.block).cast("int")
    met = stage(labelled.join(mixed, "bucket"))
    wanted = stage(met.select("node").distinct())
    texts = join_counted(_texts(docs).select("node", "text"), wanted, ["node"], "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    brought = texts.mapInArrow(_celled(settings), "node binary, cells binary").join(nodes.select("node", "bands", "sig"), "node")
    own = met.join(brought, "node").select("*", parts.alias("_p"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("own"))
    spread = own.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_p") - 1)))
    spread = spread.select("bucket", F.least("own", "_o").alias("i"), F.greatest("own", "_o").alias("j"), "own", "node", "label", "bands", "sig", "cells")
    dealt = spread.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    late = stage(dealt.mapInPandas(_blocks(settings), "a binary, b binary"))
    # links between components, as links between labels
    named = lambda side: F.coalesce(f"_{side}", side).alias(side)
    of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"_{side}"))
    between = late.join(of("a"), "a", "left").join(of("b"), "b", "left").select(named("a"), named("b")).distinct()
    again = components(between).select(F.col("node").alias("label"), F.col("label").alias("_final"))
    # a node without a link of its own may have one now
    known = nodes.select("node", "least_id").join(labels, "node", "left").select("node", "least_id", F.coalesce("label", "node").alias("label"))
    final = stage(known.join(again, "label", "left").select("node", "least_id", F.coalesce("_final", "label").alias("label")))
    ids = final.groupBy("label").agg(F.min("least_id").alias("class_id"))
    return rows.select("doc_id", "node"), stage(final.join(ids, "label").select("node", "label", "class_id"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row: ``doc_id, class_id``."""
    rows, named = classes(docs, settings)
    return rows.join(named, "node").select("doc_id", "class_id")


def without_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of every class, that of the smallest ``doc_id``, with the input's columns."""
    rows, named = classes(docs, settings)
    least = join_null_safe(rows.withColumnRenamed("doc_id", "_id"), named, ["node"]).where(F.col("_id").eqNullSafe(F.col("class_id")))
    chosen = stage(least.groupBy("label").agg(F.min(F.struct("_id", "node")).alias("c")).select(F.col("c._id").alias("doc_id"), F.col("c.node").alias("node")))
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.unhex(F.md5(normal(text_of()))).alias("node"))
    kept = join_null_safe(keyed, chosen, ["doc_id", "node"])
    # rows repeated in full, or with the same id and words
    return kept.groupBy("doc_id", "node").agg(F.first("_row").alias("_row")).select("_row.*")
