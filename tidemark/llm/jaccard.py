"""Documents linked by the Jaccard index of their four-word shingles: a T-occurrence search.

Two sets of sizes m and n link if 100 x overlap >= 85 x union, that is, if the overlap reaches
T = ceil(85 (m + n) / 185).  The result is exact, whatever the order of the rows.

1.  *Sampled lists.*  The shingles in one of ``sampled`` parts of the hash range are sent to inverted
    lists, at most two owners a batch and shingle.  A set may lose 15 % of its shingles at most, so
    a document lives on only if all but that many of its sampled shingles have another owner.
2.  *Lists by length.*  The shingles of the others are ordered by the length of their lists, shortest
    first.  At most T - 1 lists of a document are long (DivideSkip with the largest number of
    skipped lists): a partner occurs at least once in the short ones, the first n - T + 1.  Short
    lists are merged by a shuffle that sorts them by shingle; a position in the order bounds what
    is left of the overlap, so most pairs end there.
3.  *Stars first.*  In every short list, documents are compared with the one whose lists are longest, then
    those that are still alone with the one among them.  Links give components.
4.  *Search.*  In lists that still hold several components, documents outside the list's largest component
    look for partners in other components; hits are counted by pair.
5.  A candidate is confirmed by binary search of one document's shingles among the other's, which is
    where the long lists are probed.  Pairs inside a component are never compared, so a group of
    copies costs about as many comparisons as it has members, and no link between components is lost.

``bucket`` bounds the postings that a task holds in step 1; ``at_once`` the bytes of text that are hashed
together.  Shingles are 64-bit hashes; a document is its normalised text, by MD5.

Defined cases: a null text is empty; documents without words have size 0 and link with nothing, not
with each other; repeated rows are linked; a component's id is the smallest ``doc_id`` in it, null if
it has none; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, join_counted, lower_ascii, ship_by_value, stage
from tidemark.llm.neardup import components

ship_by_value(__name__)


@dataclass(frozen=True)
class Settings:
    words: int = 4
    percent: int = 85
    sampled: int = 4
    bucket: int = 100_000
    at_once: int = 250_000


_U = np.uint64
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_known: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _known or len(_known[base]) < n:
        out = np.full(max(n, 4096), _U(base))
        out[0] = 1
        _known[base] = np.multiply.accumulate(out)
    return _known[base][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingle_sets(texts: Iterable[bytes], words: int, at_once: int = 250_000) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of every text; texts have single blanks between words."""
    return [s for sets in _sets_of(texts, words, at_once) for s in sets]


def _sets_of(texts: Iterable[bytes], words: int, at_once: int) -> Iterator[list[np.ndarray]]:
    """The sets in order, those of ``at_once`` bytes of text at a time.

    Texts are hashed many at a time: a shingle is a difference of one running polynomial hash.
    """
    some: list[bytes] = []
    size = 0
    for text in texts:
        if some and size + len(text) > at_once:
            yield _hashed(some, words)
            some, size = [], 0
        some.append(text)
        size += len(text) + 1
    if some:
        yield _hashed(some, words)


def _hashed(texts: list[bytes], words: int) -> list[np.ndarray]:
    full = [i for i, t in enumerate(texts) if t]
    out = [np.zeros(0, np.uint64)] * len(texts)
    if not full:
        return out
    data = np.frombuffer(b" ".join(texts[i] for i in full), np.uint8)
    running = np.concatenate([[_U(0)], np.add.accumulate((data.astype(np.uint64) + _U(1)) * _powers(_BASE, len(data)))])
    blanks = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(data)]])
    n_words = np.array([texts[i].count(b" ") + 1 for i in full])
    first = np.cumsum(n_words) - n_words
    sizes = np.maximum(n_words - words + 1, 1)
    at = np.cumsum(sizes) - sizes
    begin = np.repeat(first - at, sizes) + np.arange(sizes.sum())
    finish = np.minimum(begin + words, np.repeat(first + n_words, sizes)) - 1
    s = starts[begin]
    hashes = _mixed((running[ends[finish]] - running[s]) * _powers(_INVERSE, len(data) + 1)[s])
    for i, a, n in zip(full, at.tolist(), sizes.tolist(), strict=True):
        out[i] = np.unique(hashes[a : a + n])
    return out


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(lower_ascii(text), r"[\x20\x09-\x0D]+", " "))


def _texts(docs: DataFrame) -> DataFrame:
    plain = documents(docs).select("doc_id", normal(F.col("text")).alias("text"))
    return plain.select("doc_id", F.unhex(F.md5("text")).alias("node"), "text")


def _posted(settings: Settings, buckets: int):
    """A row for every document (what it needs, and has in its batch), and postings by bucket."""
    bound = _U(2**62 // settings.sampled * 4 - 1)
    shift = _U(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
            texts = batch.column("text")
            # of a text's set only the size and a copy of the sampled part outlive the texts hashed with it
            sizes, parts = [], []
            for sets in _sets_of((texts[int(i)].as_py().encode() for i in where), settings.words, settings.at_once):
                sizes += [len(s) for s in sets]
                parts += [s[: np.searchsorted(s, bound, "right")].copy() for s in sets]
            n = np.array(sizes, np.int64)
            found = np.array([len(p) for p in parts])
            need = np.where(n > 0, found - (100 - settings.percent) * n // 100, 2**31 - 1)
            hashes, own = np.concatenate([*parts, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(parts)), found)
            order = np.argsort(hashes, kind="stable")
            hashes, own = hashes[order], own[order]
            new = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
            number = np.arange(len(hashes)) - np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))
            # two owners are sent and counted where the lists meet, the others have theirs already
            got = np.bincount(own[number >= 2], minlength=len(parts))
            hashes, own = hashes[number < 2], own[number < 2]
            bucket = (hashes >> shift) * _U(buckets) // (bound // _U(2**32) + _U(1))
            order = np.lexsort([own, bucket])
            hashes, own, bucket = hashes[order], own[order], bucket[order]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)]).tolist()
            spans = [*zip(cuts, [*cuts[1:], len(bucket)])]
            rows = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("node"), batch.column("key"), pa.array(n[back], pa.int64()), pa.array(need[back], pa.int64()), pa.array(got[back], pa.int64()),
                 pa.nulls(len(keys), pa.int32()), pa.nulls(len(keys), pa.binary()), pa.nulls(len(keys), pa.binary())], names)
            yield rows
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(spans), f.type) for f in rows.schema][:6] + [
                    pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
                    pa.array([distinct[own[a:b]].tobytes() for a, b in spans], pa.binary()),
                    pa.array([hashes[a:b].tobytes() for a, b in spans], pa.binary())], names)

    names = ["doc_id", "node", "key", "n", "need", "got", "bucket", "keys", "hashes"]
    return run


def _shared(table: pa.Table) -> pa.Table:
    """How many postings of every document have another owner, in one bucket."""
    joined = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    keys, hashes = joined("keys", np.int64), joined("hashes", np.uint64)
    order = np.lexsort([keys, hashes])
    keys, hashes = keys[order], hashes[order]
    once = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])])
    keys, hashes = keys[once], hashes[once]
    same = hashes[1:] == hashes[:-1]
    several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    key, count = np.unique(keys[several], return_counts=True)
    return pa.table([pa.array(key), pa.array(count)], ["key", "got"])


def _sets(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for sets in _sets_of((t.as_py().encode() for t in batch.column("text")), settings.words, settings.at_once):
                cells = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(done, len(sets)), cells], ["node", "cells"])
                done += len(sets)
    return run


def _confirmed(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("cells"), batch.column("other"), strict=True):
                x, y = one.values.to_numpy().view(np.uint64), other.values.to_numpy().view(np.uint64)
                overlap = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * overlap >= settings.percent * (len(x) + len(y) - overlap))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _linked(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    both = pairs.join(sets.select(F.col("node").alias("a"), "cells"), "a").join(sets.select(F.col("node").alias("b"), F.col("cells").alias("other")), "b")
    return stage(both.select("a", "b", "cells", "other").mapInArrow(_confirmed(settings), "a binary, b binary"))


def candidates(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Staged rows (``doc_id, node, key, n``) of all documents, and sets (``node, n, cells``) of those that
    step 1 leaves."""
    texts = _texts(docs).select("doc_id", "node", F.xxhash64("node").alias("key"), "text")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("n")).first()["n"] or 0
    buckets = 1 + size // (6 * settings.sampled * settings.bucket)
    kind = texts.schema["doc_id"].dataType.simpleString()
    posted = stage(texts.mapInArrow(_posted(settings, buckets), f"doc_id {kind}, node binary, key bigint, n bigint, need bigint, got bigint, bucket int, keys binary, hashes binary"))
    rows, lists = posted.where("bucket IS NULL"), posted.where("bucket IS NOT NULL").select("bucket", "keys", "hashes")
    shared = lists.groupBy("bucket").applyInArrow(_shared, "key bigint, got bigint").select("key", F.lit(0).cast("long").alias("need"), "got")
    alive = rows.select("key", "need", "got").union(shared).groupBy("key").agg(F.max("need").alias("need"), F.sum("got").alias("got")).where("got >= need").select("key")
    chosen = rows.select("doc_id", "node", "key").join(alive, "key", "left_semi").groupBy("node").agg(F.xxhash64(F.min("doc_id")).alias("_id"))
    ids = stage(chosen.select("_id").distinct())
    found = join_counted(documents(docs).withColumn("_id", F.xxhash64("doc_id")), ids, ["_id"], "left_semi")
    sets = _texts(found).select("node", "text").mapInArrow(_sets(settings), "node binary, cells array<bigint>")
    sets = sets.groupBy("node").agg(F.first("cells").alias("cells")).where(F.size("cells") > 0)
    return rows.select("doc_id", "node", "key", "n"), stage(sets.select("node", F.size("cells").alias("n"), "cells"))


def short_lists(sets: DataFrame, settings: Settings) -> DataFrame:
    """Postings (``h, node, n, pos, weight``) of the first n - T + 1 shingles of every document, rarest first."""
    postings = sets.select("node", "n", F.explode("cells").alias("h"))
    length = postings.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ordered = postings.join(length, "h").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    least = F.expr(f"({settings.percent} * n + 99) DIV 100")
    # shingles that no other document has come first and are in no list
    alone = (F.col("n") - F.size("s")).cast("int")
    some = ordered.select("node", "n", alone.alias("_alone"), F.aggregate("s", F.lit(0.0), lambda t, x: t + x["df"]).alias("_w"), "s", (F.col("n") - least + 1 - alone).cast("int").alias("_k")).where("_k > 0")
    listed = some.select("node", "n", (F.col("_w") / F.col("n")).alias("weight"), "_alone", F.posexplode(F.slice("s", F.lit(1), F.col("_k"))).alias("_i", "x"))
    return stage(listed.select(F.col("x.h").alias("h"), "node", "n", (F.col("_alone") + F.col("_i") + 1).alias("pos"), "weight"))


def _possible(settings: Settings, n: str, pos: str, other_n: str, other_pos: str) -> str:
    """Sizes fit, and what follows the two positions can reach T."""
    p = settings.percent
    return (f"100 * least({n}, {other_n}) >= {p} * greatest({n}, {other_n}) AND "
            f"{100 + p} * (1 + least({n} - {pos}, {other_n} - {other_pos})) >= {p} * ({n} + {other_n})")


def _named(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("label", F.col("node"))
    return stage(lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))


def links(sets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Links (``a, b``) that span the components of all links between the sets."""
    lists = short_lists(sets, settings)
    found: DataFrame | None = None
    labels: DataFrame | None = None
    for alone in (False, True):
        named = _named(lists, labels)
        members = named.where("label = node") if alone else named
        heads = members.groupBy("h").agg(F.max(F.struct("weight", "node", "n", "pos", "label")).alias("head"), F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a != _b").select("h", "head")
        pairs = members.join(heads, "h").where(f"label != head.label AND {_possible(settings, 'n', 'pos', 'head.n', 'head.pos')}")
        more = _linked(stage(pairs.select(F.col("node").alias("a"), F.col("head.node").alias("b")).distinct()), sets, settings)
        found = more if found is None else found.union(more)
        labels = components(found)
    named = _named(lists, labels)
    counted = named.groupBy("h", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("h").agg(F.max(F.struct("c", "label")).alias("_top"), F.count(F.lit(1)).alias("_labels"))
    mixed = stage(named.join(counted.where("_labels > 1").select("h", F.col("_top.label").alias("_top")), "h"))
    seeking = mixed.where("label != _top").select("h", F.col("node").alias("a"), F.col("label").alias("_la"), F.col("n").alias("_na"), F.col("pos").alias("_pa"))
    met = seeking.join(mixed, "h").where(f"label != _la AND (label = _top OR a < node) AND {_possible(settings, '_na', '_pa', 'n', 'pos')}")
    hits = met.groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("hits"))
    return stage(found.union(_linked(stage(hits.select("a", "b")), sets, settings)))


def linked_components(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id``."""
    rows, sets = candidates(docs, settings)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    labels = components(links(sets, settings))
    joined = stage(nodes.join(labels, "node", "left").where("label IS NOT NULL OR copies > 1").select("node", F.coalesce("label", "node").alias("label"), "least"))
    ids = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    special = stage(joined.join(ids, "label").select("node", F.struct("component_id").alias("c")))
    out = join_counted(rows, special, ["node"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("c.component_id")).alias("component_id"))
