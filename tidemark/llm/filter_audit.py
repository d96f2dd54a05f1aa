"""How five filters interact: what each removes, repeats, or removes alone, in every order.

Four filters judge a text by itself (words, distinct words, capitals, symbols); the fifth, E,
fails every text that a row with a smaller ``doc_id`` has too.  Equal texts are found in radix
tries:

1.  A sample of the texts, weighted by size, gives the bounds of the shards.  A bound is the shortest
    prefix that separates it from the text before it, so prefixes are longer where texts are
    alike.  Texts that share more than ``prefix`` characters give equal bounds; the shards
    between those are told apart by a hash of the text.  Bounds balance the work, nothing else.
2.  Every batch of rows is inserted into a compressed trie first.  A row whose text has a smaller id in
    its own batch fails E already and travels without its text, so a text arrives at its shard at
    most once a batch, however many copies there are.
3.  A shard inserts the full texts into its trie; a terminal holds the smallest id.  Traversed a
    second time, every row learns whether its id is larger.
4.  Rows become masks of five bits, counted by part, mask and label; a part is then 32 counts
    at most, from which all orders and steps follow.

``shard_bytes`` bounds the texts that a task holds (a sample decides, so twice that is usual),
``sampled`` the texts of the sample per shard, of which the driver gets ``prefix`` characters.

Defined cases: a null text is empty (it fails A, and E where a smaller id has an empty text);
a repeated row counts again, and with its own id alone does not fail E; a null ``doc_id`` is neither
smaller nor larger than another and has no label; a null source is the empty part; a document with several
rows in ``labels`` has quality or toxicity 1 if one of them has; an empty table gives no part.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, permutations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, ship_by_value

ship_by_value(__name__)

# The filters and their limits.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 50, 65, 5, re.compile(rb"[#$%&*|]")

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


@dataclass(frozen=True)
class Settings:
    shard_bytes: int = 32_000_000
    sampled: int = 24
    prefix: int = 1024


class RadixTrie:
    """A compressed trie over byte strings; every terminal has the smallest id inserted there."""

    def __init__(self) -> None:
        self.label: list[bytes] = [b""]
        self.least: list = [None]
        #: node and first byte of the edge -> child
        self.child: dict[tuple[int, int], int] = {}

    def _node(self, label: bytes) -> int:
        self.label.append(label)
        self.least.append(None)
        return len(self.label) - 1

    def insert(self, text: bytes, key) -> int:
        """The terminal of the text, after ``key`` (None: no id) was offered to it."""
        node, at, end = 0, 0, len(text)
        while at < end:
            child = self.child.get((node, text[at]))
            if child is None:
                child = self._node(text[at:])
                self.child[node, text[at]] = child
                node, at = child, end
                break
            label = self.label[child]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = common_length(label, text[at : at + len(label)])
            middle = self._node(label[:shared])
            self.label[child] = label[shared:]
            self.child[node, label[0]] = middle
            self.child[middle, label[shared]] = child
            node, at = middle, at + shared
        if key is not None and (self.least[node] is None or key < self.least[node]):
            self.least[node] = key
        return node


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def own_mask(text: str, data: bytes) -> int:
    """Bits of the filters A to D that the text fails."""
    words = data.split()  # of bytes: at the six white-space characters
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, _CAPITALS))) > MOST_CAPITALS * len(text)) << 2
        | (SYMBOLS.search(data) is not None) << 3
    )


_REPEATS = 1 << 4


def shard_bounds(sample: Sequence[tuple[bytes, int]], shards: int) -> list[bytes]:
    """At most ``shards`` - 1 ascending bounds that cut the sample (text, weight) into equal weights."""
    ordered, bounds, passed, before = sorted(sample), [], 0, b""
    total = sum(weight for _, weight in ordered)
    for text, weight in ordered:
        while passed * shards >= (len(bounds) + 1) * total and len(bounds) < shards - 1:
            bounds.append(text[: common_length(text, before) + 1] if text != before else text)
        passed, before = passed + weight, text
    return sorted(bounds)


def shard_of(text: bytes, bounds: Sequence[bytes], repeats: dict[bytes, int]) -> int:
    """Equal texts have equal shards; a bound that occurs several times shares its texts out by hash."""
    at = bisect_right(bounds, text)
    if at and (n := repeats[bounds[at - 1]]) > 1:
        at -= xxhash.xxh64_intdigest(text) % n
    return at


def _bounds(docs: DataFrame, settings: Settings) -> tuple[list[bytes], int]:
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(1, -(-size // settings.shard_bytes))
    if shards == 1:
        return [], 1
    rows = docs.select("text", F.octet_length("text").alias("size"))
    mean = size / max(1, docs.count())
    every = max(1, int(size / mean / (shards * settings.sampled)))
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    distinct = chosen.groupBy(F.xxhash64("text")).agg(F.first(F.substring("text", 1, settings.prefix)).alias("text"), F.first("size").alias("size"))
    return shard_bounds([(r.text.encode(), r.size) for r in distinct.select("text", "size").collect()], shards), shards


def _judged(bounds: Sequence[bytes], shards: int):
    repeats = {b: sum(1 for _ in same) for b, same in groupby(bounds)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trie, rows = RadixTrie(), {}
            ids, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
            texts = batch.column("text")
            for i, key in enumerate(ids):
                text = texts[i].as_py()
                data = text.encode()
                rows[i] = trie.insert(data, key), own_mask(text, data)
            found: dict[tuple, list[int]] = {}
            for i, (terminal, mask) in rows.items():
                larger = ids[i] is not None and ids[i] > trie.least[terminal]
                found.setdefault((ids[i], parts[i], mask | _REPEATS if larger else mask, None if larger or ids[i] is None else terminal), []).append(i)
            out = []
            for (key, part, mask, terminal), same in found.items():
                text = None if terminal is None else texts[same[0]].as_py().encode()
                shard = same[0] % shards if text is None else shard_of(text, bounds, repeats)
                out.append((shard, key, part, mask, len(same), text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True) if out else [[]] * 6, [pa.int32(), batch.schema.field("doc_id").type, pa.string(), pa.int32(), pa.int64(), pa.binary()], strict=True)],
                ["shard", "doc_id", "part", "mask", "rows", "text"])
    return run


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie, waiting = RadixTrie(), []
    for batch in batches:
        narrow = batch.select(["doc_id", "part", "mask", "rows"])
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        waiting.append((narrow, [trie.insert(texts[i].as_py(), ids[i]) if texts[i].is_valid else None for i in range(len(ids))]))
    for narrow, terminals in waiting:
        ids, masks = narrow.column("doc_id").to_pylist(), narrow.column("mask").to_pylist()
        final = [m | _REPEATS if t is not None and key > trie.least[t] else m for key, t, m in zip(ids, terminals, masks, strict=True)]
        yield narrow.set_column(2, "mask", pa.array(final, pa.int32()))


def masks(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, part, mask, rows``: bit i of the mask is set where the rows fail filter i."""
    work = documents(docs, "source").select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    bounds, shards = _bounds(work, settings)
    key = work.schema["doc_id"].dataType.simpleString()
    sent = work.mapInArrow(_judged(bounds, shards), f"shard int, doc_id {key}, part string, mask int, rows bigint, text binary")
    dealt = sent.repartitionById(shards, "shard") if shards > 1 else sent.repartition(1)
    return dealt.mapInArrow(_marked, f"doc_id {key}, part string, mask int, rows bigint")


def labelled_masks(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``part, mask, n, good, toxic``: rows, and those labelled good or toxic, of every part and mask."""
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    joined = masks(docs, settings).join(known, "doc_id", "left")
    counted = lambda c: F.coalesce(F.sum(F.col("rows") * F.coalesce(c, F.lit(0))), F.lit(0)).alias(c)
    return joined.groupBy("part", "mask").agg(F.sum("rows").alias("n"), counted("good"), counted("toxic"))


def audit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per part, order of the filters and step; counts of documents."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    earlier = [[sum(bit[f] for f in order[:i]) for i in range(len(FILTERS))] for order in orders]
    fails = [[bit[f] for f in order] for order in orders]
    parts = labelled_masks(docs, labels, settings).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))
    placed = parts.select("part", "m", F.posexplode(F.lit(orders)).alias("_o", "filter_order"))
    placed = placed.select("part", "m", "filter_order", F.explode(F.arrays_zip(
        F.sequence(F.lit(1), F.lit(len(FILTERS))).alias("step"),
        F.element_at(F.lit(earlier), F.col("_o") + 1).alias("earlier"),
        F.element_at(F.lit(fails), F.col("_o") + 1).alias("bit"))).alias("s"))
    placed = placed.select("part", "m", "filter_order", "s.step", "s.earlier", "s.bit")

    def count(which: str, value: str = "x.n") -> F.Column:
        return F.expr(f"aggregate(m, 0L, (total, x) -> total + if({which}, {value}, 0L))")

    here = "x.mask & bit != 0 AND x.mask & earlier = 0"
    return placed.select(
        "part", "filter_order", "step",
        count("x.mask & (bit | earlier) = 0").alias("kept"),
        count(here).alias("removed"),
        count("x.mask & bit != 0 AND x.mask & earlier != 0").alias("redundant"),
        count("x.mask = bit").alias("unique_fails"),
        count(here, "x.good").alias("good_lost"),
        count(here, "x.toxic").alias("toxic_lost"),
        # of the orders of a mask's bits, this filter comes first in one of popcount
        count("x.mask & bit != 0", f"x.n * cast({len(orders)} / bit_count(x.mask) AS bigint)").alias("shapley"),
    )
