"""Sources mixed to target weights, as fixed-length blocks dealt to output shards.

1.  A document's size is its number of words.  Sources, by code point with null last, weigh 5, 2
    and 1 in turn and share ``rate`` times all words; a target stops at ``most`` times its
    source's words, and the excess goes to the others by weight until none is above.
2.  The documents of a source, in a fixed pseudorandom order, are one stream of words, cut into
    blocks of ``block_words``; running sums place every document in its stream.
3.  Every output shard draws how many of its slots each source fills: a multinomial draw given
    that all shards together use every source's quota, made by halving the range of shards, so
    a shard finds its own counts and its place in the sources' sequences without the others.
4.  The k-th slot of a source takes the block that a keyed permutation of the source's block
    indices maps k to, a new permutation for every pass, so no block comes more than ``most``
    times and no index is ever shuffled or collected.
5.  Slots and blocks are joined by source and block index.

On the driver: one row per source, nothing else.  Running sums are summed by slices of a source,
so a source that holds a third of all rows is spread like the rest.

Defined cases: a null text has size 0; empty documents are never taken; a null source is a
source, the last; repeated rows are documents each; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, join_null_safe, ship_by_value, stage, word_count

ship_by_value(__name__)

#: rows of a slice whose running sums one task computes, about
SLICE_ROWS = 4_000
#: so many are drawn one by one at the end of a draw
_ONE_BY_ONE = 32


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    rate: float = 1.5
    most: int = 2
    block_words: int = 128
    shard_slots: int = 4096
    seed: int = 20240501


def targets(sizes: list[int], mix: Mix = Mix()) -> list[float]:
    """Words to take from every source, in their order."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    limits = [float(mix.most * n) for n in sizes]
    out, free, left = list(limits), set(range(len(sizes))), mix.rate * sum(sizes)
    while free:
        share = left / sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * share > limits[i]}
        if not full:
            for i in free:
                out[i] = weights[i] * share
            break
        left -= sum(limits[i] for i in full)
        free -= full
    return out


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where a permutation of range(n) maps ``k``: four Feistel rounds over the next even power
    of two, again until the value lies in range."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.SeedSequence(key).generate_state(4, np.uint64)
    out, todo = k.astype(np.uint64), np.ones(len(k), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for c in keys:
            mixed = (right + c) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def _half(colours: np.ndarray, drawn: int, seed: tuple[int, ...]) -> np.ndarray:
    """How many of each colour are among ``drawn`` of them, exactly, for any number of them.

    Every one falls into the draw with the wanted share as its chance.  Of a surplus as many go
    out again, of those left a lack is filled, both in the same way; each time about the square
    root is left to put right, and the last few are drawn one by one.
    """
    rng = np.random.default_rng(seed)
    taken, pool, sign = np.zeros_like(colours), colours.copy(), 1
    while drawn > _ONE_BY_ONE:
        hit = rng.binomial(pool, drawn / pool.sum())
        taken += sign * hit
        over = int(hit.sum()) - drawn
        pool, drawn, sign = (hit, over, -sign) if over > 0 else (pool - hit, -over, sign)
    for _ in range(drawn):
        one = int(np.searchsorted(np.cumsum(pool), rng.integers(pool.sum()), side="right"))
        pool[one] -= 1
        taken[one] += sign
    return taken


def shard_counts(quota: np.ndarray, shard: int, slots: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard's slots by source, and how many slots of every source the shards before it have."""
    total = int(quota.sum())
    low, high = 0, -(-total // slots)
    counts, before = quota.astype(np.int64), np.zeros(len(quota), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left = _half(counts, (middle - low) * slots, (seed, low, high))
        if shard < middle:
            counts, high = left, middle
        else:
            before, counts, low = before + left, counts - left, middle
    return counts, before


def _slots(quota: list[int], blocks: list[int], mix: Mix):
    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        quotas = np.array(quota, np.int64)
        for frame in frames:
            for shard in frame["id"]:
                counts, before = shard_counts(quotas, int(shard), mix.shard_slots, mix.seed)
                source = np.repeat(np.arange(len(quota)), counts)
                index = np.empty(len(source), np.int64)
                for s in np.flatnonzero(counts):
                    k = before[s] + np.arange(counts[s])
                    block = np.empty(len(k), np.int64)
                    for turn in np.unique(k // blocks[s]):
                        of = k // blocks[s] == turn
                        block[of] = permuted(k[of] % blocks[s], blocks[s], hash((mix.seed, int(s), int(turn))) & (2**63 - 1))
                    index[source == s] = block
                place = np.random.default_rng((mix.seed, int(shard))).permutation(len(source))
                yield pd.DataFrame({"shard": shard, "slot": place, "_s": source, "block": index})
    return deal


def placed(docs: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, list[tuple]]:
    """Every document's place in its source's stream, staged, and (source, words, target) by source.

    ``doc_id, source, size, _h, _s, start``: ``_h`` is a hash of the row, ``_s`` the source's number.
    """
    spark = docs.sparkSession
    sized = stage(documents(docs, "source").select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("_h")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    aims = targets([r["n"] for r in totals], mix)
    listed = [(i, r["source"], r["n"], aim) for i, (r, aim) in enumerate(zip(totals, aims, strict=True))]
    names = spark.createDataFrame([x[:2] for x in listed], "_s int, _name string")
    slices = sum(r["rows"] for r in totals) // SLICE_ROWS + 1
    rows = sized.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("_name"))).drop("_name").withColumn("_b", F.pmod("_h", F.lit(slices)))
    sums = rows.groupBy("_s", "_b").agg(F.sum("size").alias("_n"))
    order = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("_s", "_b", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_begin"))
    within = Window.partitionBy("_s", "_b").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("_in", F.coalesce(F.sum("size").over(within), F.lit(0)))
    table = inside.join(begins, ["_s", "_b"]).select("doc_id", "source", "size", "_h", "_s", (F.col("_begin") + F.col("_in")).alias("start"))
    return stage(table), listed


def mixed(docs: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame, list[tuple]]:
    """The mix, the documents' places, and (number, source, words, target) by source.

    The mix has one row per slot and document in its block: ``shard, slot, _s, block, start,
    doc_id, _h, from_word, n_words``; :func:`with_text` adds the words.
    """
    spark = docs.sparkSession
    table, listed = placed(docs, mix)
    n = mix.block_words
    blocks = [-(-words // n) for _, _, words, _ in listed]
    quota = [min(mix.most * b, round(aim * b / words)) if words else 0 for b, (_, _, words, aim) in zip(blocks, listed, strict=True)]
    shards = -(-sum(quota) // mix.shard_slots)
    slots = spark.range(0, shards, 1, min(max(shards, 1), 4096)).mapInPandas(_slots(quota, blocks, mix), "shard long, slot int, _s int, block long")
    ends = F.col("start") + F.col("size")
    parts = table.where("size > 0").select("*", F.explode(F.sequence(F.floor(F.col("start") / n), F.floor((ends - 1) / n))).alias("block"))
    first = F.greatest(F.col("block") * n - F.col("start"), F.lit(0))
    members = parts.select("_s", "block", "start", "doc_id", "_h", first.alias("from_word"), (F.least(F.col("block") * n + n, ends) - F.col("start") - first).alias("n_words"))
    # both sides grow with the corpus, whatever the optimizer makes of the few rows before mapInPandas
    return slots.hint("merge").join(members, ["_s", "block"]), table, listed


def with_text(mix_rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds ``words``, the words of the document that the block holds."""
    key = ["doc_id", "_h"]
    texts = documents(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("_h"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)).alias("_w")).dropDuplicates(key)
    return join_null_safe(mix_rows, texts, key).select(*mix_rows.columns, F.slice("_w", (F.col("from_word") + 1).cast("int"), F.col("n_words").cast("int")).alias("words"))


def taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per row: ``doc_id, source, size, source_size, target, taken``."""
    rows, table, listed = mixed(docs, mix)
    spark: SparkSession = docs.sparkSession
    by_start = rows.groupBy("_s", "start").agg(F.sum("n_words").alias("taken"))
    sources = spark.createDataFrame([(s, words, float(aim)) for s, _, words, aim in listed], "_s int, source_size long, target double")
    full = table.where("size > 0").join(by_start, ["_s", "start"], "left")
    empty = table.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return full.unionByName(empty).join(F.broadcast(sources), "_s").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
