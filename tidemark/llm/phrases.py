"""Collocations: frequent phrases of a language, scored by their weakest cut.

1.  Texts are cut into pieces and words once.  Every chunk is stored as numbers of its own words, with
    the words and their counts; the counts are summed by language, words under the minimum go,
    and the others get dense numbers, joined back to the chunks.  From here on all passes read
    arrays of numbers in which 0 ends a phrase; a number stands for a word of one language.
2.  Candidates are phrases of two to four words that may be frequent: their first words and their last
    words are candidates themselves (Apriori), and the tasks found them often enough together.  For
    that a task sends a key and a count no larger than the minimum; the sum of those reaches the
    minimum where the sum of the counts does.
3.  The candidates of one length go into a double-array trie, which is broadcast.  A task moves the states
    of all text positions at once, level by level, keeps the positions that are still inside the trie,
    and counts the accepting states by ``bincount``; the counts of the tasks are summed.  The
    same pass proposes the phrases that are one word longer, if their last words are in a bitmap of
    the candidates (an exact join follows).
4.  Scores, containment and ranks are DataFrame operations on the frequent phrases.

A trie holds at most about ``shard`` phrases.  More phrases are dealt by hash to several tries, which
are broadcast one after the other, so neither the driver nor a task holds more than one; the
bitmap has 8 MB at any size and only saves proposals.  Cuts,
inclusion and scores are exact: products are decimals.

Defined cases: a null text is empty and has no words; a null language is ``und``; repeated rows
count again; an empty table gives an empty result; equal scores are ordered by count and phrase.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship_by_value, stage, text_of

ship_by_value(__name__)

# Ends of a piece; words are runs of anything but blank and tab.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"


@dataclass(frozen=True)
class Settings:
    least: int = 30
    words: int = 4
    inside: int = 80
    first: int = 2000
    #: phrases in one trie, bytes of text in one chunk, words in one block of numbers
    shard: int = 500_000
    chunk: int = 2_000_000
    block: int = 20_000
    #: distinct keys that a task holds before it sends them
    held: int = 400_000
    salts: int = 32


class DoubleArray:
    """A trie over rows of ``k`` positive numbers; every number is two digits, so two levels.

    The child of state s under digit d is ``base[s] + d`` if ``check`` holds s there.  ``value`` is the row
    of a state that accepts.  States with many children are placed one by one at the first base that
    fits, the others all at once at random bases, again until none collide.
    """

    def __init__(self, rows: np.ndarray, largest: int) -> None:
        self.rows, self.k = rows, rows.shape[1]
        self.radix = int(np.ceil(np.sqrt(largest + 1.0)))
        digits = np.stack([d for j in range(self.k) for d in (rows[:, j] // self.radix, rows[:, j] % self.radix)], axis=1)
        order = np.lexsort(digits.T[::-1])
        digits = digits[order]
        self.base, self.check = np.zeros(1, np.int32), np.full(1, -1, np.int32)
        self._random = np.random.default_rng(1)
        self._room(2 * len(rows))
        self._from, state = 1, np.zeros(len(rows), np.int64)
        for level in range(digits.shape[1]):
            state = self._level(state, digits[:, level])
        self.value = np.full(len(self.base), -1, np.int32)
        self.value[state] = order

    def parts(self) -> tuple:
        """Arrays and numbers alone, which a task can load without this module."""
        return self.rows, self.k, self.radix, self.base, self.check, self.value

    @classmethod
    def of(cls, parts: tuple) -> DoubleArray:
        trie = cls.__new__(cls)
        trie.rows, trie.k, trie.radix, trie.base, trie.check, trie.value = parts
        return trie

    def _room(self, more: int) -> None:
        """Room for so many more states, at a load of two fifths, and a whole row after the last."""
        size = max(4096, int(2.5 * ((self.check >= 0).sum() + more))) + self.radix + 1
        if size > len(self.base):
            grown = size - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(grown, np.int32)])
            self.check = np.concatenate([self.check, np.full(grown, -1, np.int32)])

    def _level(self, state: np.ndarray, digit: np.ndarray) -> np.ndarray:
        """Places the children of all states of one level; rows come sorted by their path."""
        new_state = np.concatenate([[True], state[1:] != state[:-1]])
        new_edge = new_state | np.concatenate([[True], digit[1:] != digit[:-1]])
        parent, edge = state[new_edge], digit[new_edge]
        self._room(len(parent))
        starts = np.flatnonzero(new_state[new_edge])
        degree = np.diff(np.append(starts, len(parent)))
        base = np.zeros(len(starts), np.int64)
        taken = self.check >= 0
        taken[0] = True
        many = np.flatnonzero(degree > 8)
        for p in many[np.argsort(-degree[many], kind="stable")]:
            own = edge[starts[p] : starts[p] + degree[p]]
            while True:
                if self._from + 256 + self.radix >= len(taken):
                    self.base = np.concatenate([self.base, np.zeros(len(taken), np.int32)])
                    self.check = np.concatenate([self.check, np.full(len(taken), -1, np.int32)])
                    taken = np.concatenate([taken, np.zeros(len(taken), bool)])
                fits = np.flatnonzero(~taken[np.arange(self._from, self._from + 256)[:, None] + own].any(axis=1))
                if len(fits):
                    break
                self._from += 256
            base[p] = self._from + fits[0]
            taken[base[p] + own] = True
        todo = np.flatnonzero(degree <= 8)
        while len(todo):
            size = degree[todo]
            at = np.cumsum(size) - size
            mine = np.repeat(starts[todo] - at, size) + np.arange(size.sum())
            tried = self._random.integers(1, len(taken) - self.radix, len(todo))
            slots = np.repeat(tried, size) + edge[mine]
            clash = taken[slots]
            by = np.argsort(slots, kind="stable")
            clash[by[1:][slots[by][1:] == slots[by][:-1]]] = True
            good = np.add.reduceat(clash, at) == 0
            base[todo[good]] = tried[good]
            taken[slots[np.repeat(good, size)]] = True
            todo = todo[~good]
        slot = np.repeat(base, degree) + edge
        self.base[parent[starts]] = base
        self.check[slot] = parent
        return slot[np.cumsum(new_edge) - 1]

    def accepted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a row of the trie starts, and the row."""
        at = np.flatnonzero(ids[: max(0, len(ids) - self.k + 1)] > 0)
        state = np.zeros(len(at), np.int32)
        for j in range(self.k):
            for high in (True, False):
                number = ids[at + j]
                state_next = self.base[state] + (number // self.radix if high else number % self.radix)
                inside = (self.check[state_next] == state) & (number > 0)
                at, state = at[inside], state_next[inside]
        return at, self.value[state]


def _read(settings: Settings):
    plain = bytes.maketrans(ENDS, b"," * len(ENDS))

    def encoded(number: int, lang: str, texts: list[bytes]) -> pa.RecordBatch:
        known = {b",": 0}
        # bytes are lowered in ASCII and split at white space, of which blank and tab are left
        tokens = b" , ".join(texts).lower().translate(plain).replace(b",", b" , ").split()
        codes = np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int32, len(tokens))
        counts = np.bincount(codes, minlength=len(known))[1:]
        words = [w.decode() for w in list(known)[1:]]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([lang]), pa.array([codes.tobytes()], pa.binary()), pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64()))],
            ["chunk", "lang", "codes", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, sizes = TaskContext.get().partitionId() << 32, {}, Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                data = text.as_py().encode()
                key = lang.as_py()
                held.setdefault(key, []).append(data)
                sizes[key] += len(data) + 1
                # the language itself, or with many languages the one with most text
                if sizes[key] > settings.chunk or sizes.total() > 4 * settings.chunk:
                    largest = sizes.most_common(1)[0][0]
                    yield encoded(number, largest, held.pop(largest))
                    del sizes[largest]
                    number += 1
        for lang, texts in held.items():
            yield encoded(number, lang, texts)
            number += 1
    return run


def _renumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of a chunk become numbers of frequent words, all other words 0."""
    for batch in batches:
        out = []
        for codes, at, ids in zip(batch.column("codes"), batch.column("at"), batch.column("id"), strict=True):
            codes = np.frombuffer(codes.as_py(), np.int32)
            to = np.zeros(codes.max(initial=0) + 1, np.int32)
            if at.is_valid:
                to[at.values.to_numpy() + 1] = ids.values.to_numpy()
            out.append(to[codes].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])


def numbered(words: DataFrame, rows: int, settings: Settings) -> DataFrame:
    """Dense numbers from 1 for the staged words, block by block; no task orders more than about a block."""
    blocks = max(1, rows // settings.block)
    dealt = words.withColumn("_b", F.pmod(F.xxhash64("lang", "word"), F.lit(blocks)))
    sizes = {r["_b"]: r["n"] for r in dealt.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for b in range(blocks):
        offsets.append(before)
        before += sizes.get(b, 0)
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("lang", "word"))
    number = F.element_at(F.lit(offsets), (F.col("_b") + 1).cast("int")) + inside
    return stage(dealt.withColumn("id", number.cast("int")).drop("_b"))


def _arrays(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.ravel().astype(np.int32)))


class _Keys:
    """Distinct keys of a task and how often they occur, no further than the minimum.

    A sum of counts reaches the minimum if and only if the sum of counts cut off there does.
    """

    def __init__(self, settings: Settings) -> None:
        self.settings = settings
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(keys, return_counts=True)
        self.keys, where = np.unique(np.concatenate([self.keys, found]), return_inverse=True)
        together = np.bincount(where, np.concatenate([self.counts, n]), len(self.keys)).astype(np.int64)
        self.counts = np.minimum(together, self.settings.least)
        if len(self.keys) > self.settings.held:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        yield _sums(self.keys, self.counts)
        self.keys, self.counts = self.keys[:0], self.counts[:0]


def _sums(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], ["key", "c"])


def _pairs(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Keys(settings)
        for batch in batches:
            for value in batch.column("ids"):
                ids = np.frombuffer(value.as_py(), np.int32).astype(np.int64)
                yield from held.add((ids[:-1] << 32 | ids[1:])[(ids[:-1] > 0) & (ids[1:] > 0)])
        yield from held.sent()
    return run


_BITS = 26


def _places(phrases: list[np.ndarray]) -> np.ndarray:
    """A place in the bitmap for every phrase, given by its words' numbers."""
    h = np.zeros(len(phrases[0]), np.uint64)
    for ids in phrases:
        h = (h + ids.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - _BITS)


def _walked(trie, bitmap, settings: Settings):
    """One pass over all positions: the phrases of the trie are counted (key: row, 0), and those one word
    longer whose last words may be a candidate too are proposed (key: row, next word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array, bits = DoubleArray.of(trie.value), bitmap.value
        counts, held = np.zeros(len(array.rows), np.int64), _Keys(settings)
        for batch in batches:
            for value in batch.column("ids"):
                ids = np.append(np.frombuffer(value.as_py(), np.int32), np.int32(0))
                at, row = array.accepted(ids)
                counts += np.bincount(row, minlength=len(counts))
                if array.k < settings.words:
                    more = ids[at + array.k] > 0
                    at, row = at[more], row[more]
                    place = _places([ids[at + j] for j in range(1, array.k + 1)])
                    known = bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 > 0
                    yield from held.add(row[known].astype(np.int64) << 32 | ids[at[known] + array.k])
        found = np.flatnonzero(counts)
        yield _sums(found << 32, counts[found])
        yield from held.sent()
    return run


def _spelled_out(trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays([_arrays(trie.value[0][keys >> 32]), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), batch.column("c")], ["p", "after", "c"])
    return run


def _shards(phrases: DataFrame, k: int, settings: Settings) -> Iterator[np.ndarray]:
    """The staged phrases of k words, at most about ``shard`` at a time."""
    shards = max(1, -(-phrases.count() // settings.shard))
    dealt = phrases.select("p", F.pmod(F.xxhash64("p"), F.lit(shards)).alias("_s"))
    for s in range(shards):
        rows = dealt.where(F.col("_s") == s).select("p").toArrow().column("p").combine_chunks()
        if len(rows):
            yield rows.flatten().to_numpy().reshape(len(rows), k)


def _bitmap(phrases: DataFrame, k: int, settings: Settings) -> np.ndarray:
    bits = np.zeros(1 << _BITS, bool)
    for rows in _shards(phrases, k, settings):
        bits[_places(list(rows.T))] = True
    return np.packbits(bits, bitorder="little")


def _level(ids: DataFrame, phrases: DataFrame, k: int, largest: int, settings: Settings) -> DataFrame:
    """Staged ``p, after, c``: counts of the phrases (``after`` = 0), and proposals that are frequent."""
    context, out = ids.sparkSession.sparkContext, None
    bitmap = context.broadcast(_bitmap(phrases, k, settings) if k < settings.words else None)
    for rows in _shards(phrases, k, settings):
        trie = context.broadcast(DoubleArray(rows, largest).parts())
        summed = ids.mapInArrow(_walked(trie, bitmap, settings), "key bigint, c bigint").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= settings.least)
        part = stage(summed.mapInArrow(_spelled_out(trie), "p array<int>, after int, c bigint"))
        out = part if out is None else out.union(part)
        trie.destroy()
    bitmap.destroy()
    return out if out is not None else phrases.select("p", F.lit(0).alias("after"), F.lit(0).cast("long").alias("c"))


def frequent(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Words by language (``lang, n``), frequent words (``lang, word, f, id``), and by length from 2 on the
    frequent phrases (``p``: numbers of the words, ``f``); all staged."""
    work = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    read = stage(work.mapInArrow(_read(settings), "chunk bigint, lang string, codes binary, words array<string>, counts array<bigint>"))
    entries = read.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select("chunk", "lang", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    totals = stage(entries.groupBy("lang", "word").agg(F.sum("c").alias("f")))
    sizes = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    often = stage(totals.where(F.col("f") >= settings.least))
    largest = often.count()
    words = numbered(often, largest, settings)
    mapped = entries.select("chunk", "lang", "at", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("m"))
    full = read.select("chunk", "codes").join(mapped, "chunk", "left").select("codes", F.col("m.at").alias("at"), F.col("m.id").alias("id"))
    ids = stage(full.mapInArrow(_renumbered, "ids binary"))
    pairs = ids.mapInArrow(_pairs(settings), "key bigint, c bigint").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= settings.least)
    word = lambda c: c.cast("int")
    candidates = stage(pairs.select(F.array(word(F.shiftright("key", 32)), word(F.col("key").bitwiseAND(0xFFFFFFFF))).alias("p")))
    levels = []
    for k in range(2, settings.words + 1):
        found = _level(ids, candidates, k, largest, settings)
        levels.append(found.where("after = 0").select("p", F.col("c").alias("f")))
        if k < settings.words:
            longer = found.where("after > 0").select(F.concat("p", F.array("after")).alias("p"), F.concat(F.slice("p", 2, k - 1), F.array("after")).alias("_rest"))
            candidates = stage(longer.join(candidates.select(F.col("p").alias("_rest")), "_rest", "left_semi").select("p"))
    return sizes, words, levels


def _score() -> Column:
    return F.expr("CAST((CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0))) DIV CAST(l + r AS DECIMAL(20, 0)) AS BIGINT)")


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first phrases of every language."""
    sizes, words, levels = frequent(docs, settings)
    counts, long = words.select(F.array("id").alias("p"), "f"), levels[0]
    for level in levels[1:]:
        long = long.union(level)
    phrases = stage(long.select("p", F.col("f").alias("a"), F.size("p").alias("_size")))
    counts = counts.union(phrases.select("p", "a"))
    # the lowest-scoring cut
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("_size") - 1)))
    cuts = cuts.select("p", "a", "k", F.expr("slice(p, 1, k)").alias("_l"), F.expr("slice(p, k + 1, _size - k)").alias("_r"))
    cuts = cuts.join(counts.select(F.col("p").alias("_l"), F.col("f").alias("l")), "_l").join(counts.select(F.col("p").alias("_r"), F.col("f").alias("r")), "_r")
    scored = cuts.withColumn("score", _score()).groupBy("p").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
    # phrases that nearly always stand inside a longer one go
    spans = [(i, n) for n in range(2, settings.words) for i in range(1, settings.words - n + 2)]
    inner = [F.when(F.col("_size") >= F.lit(i + n - 1), F.slice("p", i, n)) for i, n in spans]
    longer = phrases.where("_size > 2").select("a", "_size", F.explode(F.array(*inner)).alias("_p")) if inner else phrases.select("a", "_size", F.col("p").alias("_p")).limit(0)
    longest = longer.where("_p IS NOT NULL AND size(_p) < _size").groupBy(F.col("_p").alias("p")).agg(F.max("a").alias("_longer"))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    kept = stage(scored.join(longest, "p", "left").where(F.col("_longer").isNull() | (100 * exact("_longer") < settings.inside * exact("a"))).select("p", "a", "c.*"))
    # words for numbers
    spelled = kept.select("p", F.posexplode("p").alias("i", "id")).join(words.select("id", "lang", "word"), "id")
    texts = spelled.groupBy("p").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
    named = kept.join(texts, "p").select("lang", F.array_join(F.col("w.word"), " ").alias("phrase"), "a", "l", "r", "score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = named.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(settings.salts)))
    ahead = salted.withColumn("_n", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).where(F.col("_n") <= settings.first)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= settings.first)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
