"""Language-model scores of texts by a hashed maximum-entropy model.

The probability of a token is that of its class given the words before, times its share of the
class.  The most frequent words are classes of their own; every other word is in the class of
its last two bytes, where it has the share of its smoothed training count (and unseen words
together that of half a count), so the probabilities of a position sum to 1.  Classes are
predicted by a softmax over hashed features: the word before, the two words before, and the
skips to the second and third word before, with a bias.

Training: ``rounds`` passes, each over another part of the training texts, together all of them.
Every task takes Adagrad steps on its own rows from the common weights and squares and returns the
changes of both; changes of a weight row are averaged by how often the tasks used it.  Squares are kept
over the rounds, and small partitions are read together until a task has ``task_batches`` batches
a round, so the number of steps follows the tokens, not the partitions.  Scoring: Arrow batches,
as sparse gathers of weight rows.  Token counts are those of the whole training part: the words
above a frequency that ``known_words`` bounds go with the tasks, the rest are joined as rows.

Tokens are 64-bit hashes (two of 10 million different words collide with probability 3e-6).
Tasks return ``2 ** bits`` weight rows at most; the driver holds one model and ``known_words``
counts.  Defined cases: a null text is empty and has one token, its end; a null ``doc_id`` counts
as the empty string in the split; repeated rows are scored each; with nothing to train on, all
words are unseen and classes are equally likely; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, join_null_safe, ship_by_value, stage

ship_by_value(__name__)


@dataclass(frozen=True)
class Settings:
    bits: int = 14
    head: int = 23
    tails: int = 24
    rounds: int = 3
    step: float = 0.3
    batch: int = 8192
    #: batches of a task and round, at least; partitions with less are read together
    task_batches: int = 8
    known_words: int = 1 << 18


_U = np.uint64
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
END = 0x1F83D9ABFB41BD6B
_BEFORE = _U(0x5BE0CD19137E2179)
_CHUNKS = 64
_known: dict[int, np.ndarray] = {}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 1


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _known or len(_known[base]) < n:
        out = np.full(max(n, 1 << 16), _U(base))
        out[0] = 1
        _known[base] = np.multiply.accumulate(out)
    return _known[base][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def tokens(text: str, tails: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the end, and the words' tail classes.

    A-Z become lower case; words end at the six ASCII white-space characters.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    running = np.concatenate([[_U(0)], np.add.accumulate((data.astype(np.uint64) + _U(1)) * _powers(_BASE, len(data)))])
    words = _mixed((running[ends] - running[starts]) * _powers(_INVERSE, len(data) + 1)[starts])
    last = data[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64) if len(ends) else last
    tail = (_mixed(last + (before << _U(8)) + _U(1)) % _U(tails)).astype(np.int64)
    return np.append(words, _U(END)), np.append(tail, 0)


def features(words: np.ndarray, bits: int) -> np.ndarray:
    """Weight rows of every position, one column a feature."""
    padded = np.concatenate([[_BEFORE] * 3, words]).astype(np.uint64)
    one, two, three = padded[2:-1], padded[1:-2], padded[:-3]
    keys = (one + _U(1), one * _U(0x9E3779B97F4A7C15) + two + _U(2), two * _U(3) + _U(3), three * _U(5) + _U(4))
    return np.stack([(_mixed(k) >> _U(64 - bits)).astype(np.int64) for k in keys], axis=1)


def classes_of(words: np.ndarray, tail: np.ndarray, heads: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Class numbers: position among ``heads`` (sorted; ``order`` numbers them), else after them by tail."""
    if not len(heads):
        return tail
    at = np.minimum(np.searchsorted(heads, words), len(heads) - 1)
    return np.where(heads[at] == words, order[at], len(heads) + tail)


def _counted(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, bool]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            words = np.concatenate([w for w, _, _ in held])
            tail = np.concatenate([t for _, t, _ in held])
            learn = np.concatenate([np.full(len(w), x) for w, _, x in held])
            distinct, first, inverse = np.unique(words, return_index=True, return_inverse=True)
            n = np.bincount(inverse, minlength=len(distinct))
            trained = np.bincount(inverse, weights=learn, minlength=len(distinct)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(tail[first].astype(np.int32)), pa.array(trained), pa.array(n.astype(np.int64))], ["word", "tail", "trained", "n"])

        for batch in batches:
            for text, held_out_row in zip(batch.column("text"), batch.column("held_out"), strict=True):
                words, tail = tokens(text.as_py(), settings.tails)
                held.append((words, tail, not held_out_row.as_py()))
                size += len(words)
                if size >= 2_000_000:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()
    return run


def token_counts(work: DataFrame, settings: Settings) -> DataFrame:
    """``word, tail, trained, n`` of every token, over training rows and over all; staged."""
    partial = work.select("text", "held_out").mapInArrow(_counted(settings), "word long, tail int, trained long, n long")
    return stage(partial.groupBy("word").agg(F.min("tail").alias("tail"), F.sum("trained").alias("trained"), F.sum("n").alias("n")))


@dataclass
class Counts:
    """What tasks need of the counts: the heads, and the frequent words' counts by sorted hash."""

    tokens: int
    distinct: int
    heads: np.ndarray
    order: np.ndarray
    known: np.ndarray
    known_counts: np.ndarray
    masses: np.ndarray


def summarised(counts: DataFrame, settings: Settings) -> Counts:
    total = counts.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("t"), F.count(F.when(F.col("trained") > 0, 1)).alias("v")).collect()[0]
    # the lowest frequency above which there are at most known_words words, in steps of 4 percent
    step = F.floor(F.log2("n") * 16)
    groups = sorted(((r["s"], r["c"]) for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("c")).collect()), reverse=True)
    lowest, room = None, settings.known_words
    for s, c in groups:
        room -= c
        if room < 0:
            break
        lowest = s
    often = counts.where(step >= (1 << 20 if lowest is None else lowest)).select("word", "trained").toPandas()
    words = often["word"].to_numpy(np.int64).view(np.uint64)
    by_word = np.argsort(words)
    known, known_counts = words[by_word], often["trained"].to_numpy(np.int64)[by_word]
    best = np.lexsort((known, -known_counts))[: settings.head]
    best = best[known_counts[best] > 0]
    heads = known[best]
    by_hash = np.argsort(heads)
    rest = counts.where(F.col("trained") > 0)
    if len(heads):
        rest = rest.where(~F.col("word").isin(*heads.view(np.int64).tolist()))
    masses = np.full(settings.tails, 0.5)
    for r in rest.groupBy("tail").agg(F.sum(F.col("trained") + 0.5).alias("m")).collect():
        masses[r["tail"]] += r["m"]
    return Counts(int(total["t"]), int(total["v"]), heads[by_hash], np.arange(len(heads))[by_hash], known, known_counts, masses)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def logits_of(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The last weight row is the bias."""
    out = weights[rows[:, 0]]
    for i in range(1, rows.shape[1]):
        out += weights[rows[:, i]]
    out += weights[-1]
    return out


def _steps(weights: np.ndarray, squares: np.ndarray, uses: np.ndarray, rows: np.ndarray, target: np.ndarray, step: float) -> None:
    """One Adagrad step on a batch; gradients are summed by used weight row and class with counts."""
    error = _softmax(logits_of(weights, rows))
    error[np.arange(len(target)), target] -= 1.0
    n = np.bincount(rows.ravel(), minlength=len(weights) - 1)
    at = np.flatnonzero(n)
    number = np.empty(len(n), np.int64)
    number[at] = np.arange(len(at))
    by_class, columns = np.ascontiguousarray(error.T, np.float64), np.ascontiguousarray(number[rows].T)
    gradient = np.empty((error.shape[1], len(at) + 1), np.float32)
    for c, errors in enumerate(by_class):
        gradient[c, :-1] = sum(np.bincount(column, errors, len(at)) for column in columns)
        gradient[c, -1] = errors.sum()
    gradient = np.ascontiguousarray(gradient.T)
    at = np.append(at, len(weights) - 1)
    gradient /= np.float32(len(target))
    total = squares[at] + gradient * gradient
    squares[at] = total
    weights[at] -= np.float32(step) * gradient / (np.sqrt(total) + np.float32(1e-5))
    uses[at[:-1]] += n[at[:-1]]
    uses[-1] += len(target)


def _trainer(shared, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, gathered, heads, order = shared.value
        weights, squares, uses = start.copy(), gathered.copy(), np.zeros(len(start), np.float32)
        rows, targets, size = [], [], 0
        for batch in batches:
            for value in batch.column("text"):
                words, tail = tokens(value.as_py(), settings.tails)
                rows.append(features(words, settings.bits))
                targets.append(classes_of(words, tail, heads, order))
                size += len(words)
                if size >= settings.batch:
                    all_rows, all_targets = np.concatenate(rows), np.concatenate(targets)
                    full = size - size % settings.batch
                    for i in range(0, full, settings.batch):
                        _steps(weights, squares, uses, all_rows[i : i + settings.batch], all_targets[i : i + settings.batch], settings.step)
                    rows, targets, size = [all_rows[full:]], [all_targets[full:]], size - full
        if size:
            _steps(weights, squares, uses, np.concatenate(rows), np.concatenate(targets), settings.step)
        if uses.any():
            change = np.concatenate([weights - start, squares - gathered], axis=1) * uses[:, None]
            for chunk, at in enumerate(np.array_split(np.arange(len(start)), _CHUNKS)):
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([change[at].tobytes()], pa.binary()), pa.array([uses[at].tobytes()], pa.binary())], ["chunk", "change", "uses"])
    return run


def _merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums the tasks' changes by chunk as they stream by."""
    sums: dict[int, list[np.ndarray]] = {}
    for frame in frames:
        for chunk, change, uses in zip(frame["chunk"], frame["change"], frame["uses"], strict=True):
            new = [np.frombuffer(change, np.float32).astype(np.float64), np.frombuffer(uses, np.float32).astype(np.float64)]
            sums[chunk] = [a + b for a, b in zip(sums[chunk], new, strict=True)] if chunk in sums else new
    yield pd.DataFrame([(c, a.tobytes(), b.tobytes()) for c, (a, b) in sums.items()], columns=["chunk", "change", "uses"])


def train(work: DataFrame, counts: Counts, settings: Settings) -> np.ndarray:
    """Weights of 2 ** bits feature rows and a bias row, by class."""
    tasks = max(1, counts.tokens // (settings.rounds * settings.task_batches * settings.batch))
    context = work.sparkSession.sparkContext
    classes = len(counts.heads) + settings.tails
    weights = np.zeros(((1 << settings.bits) + 1, classes), np.float32)
    squares = np.zeros_like(weights)
    schema = "chunk int, change binary, uses binary"
    for turn in range(settings.rounds):
        part = work.where(~F.col("held_out") & (F.pmod(F.col("_text"), F.lit(settings.rounds)) == turn)).select("text").coalesce(tasks)
        shared = context.broadcast((weights, squares, counts.heads, counts.order))
        parts = part.mapInArrow(_trainer(shared, settings), schema)
        merged = parts.repartition(min(_CHUNKS, 16), "chunk").mapInPandas(_merged, schema)
        weights, squares = weights.copy(), squares.copy()
        for row in merged.collect():
            at = np.array_split(np.arange(len(weights)), _CHUNKS)[row["chunk"]]
            uses = np.frombuffer(row["uses"])
            change = np.frombuffer(row["change"]).reshape(len(at), 2 * classes) / np.maximum(uses, 1.0)[:, None]
            weights[at] += change[:, :classes].astype(np.float32)
            squares[at] += change[:, classes:].astype(np.float32)
        shared.unpersist()
    return weights


def _scorer(shared, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, fields = shared.value
        counts = Counts(**fields)
        heads = len(counts.heads)
        logs = np.log10(counts.known_counts + 0.5)
        masses = np.log10(np.concatenate([np.ones(heads), counts.masses]))
        for batch in batches:
            out: list[tuple] = []
            texts = [tokens(x.as_py(), settings.tails) for x in batch.column("text")]
            for i in range(0, len(texts), 64):
                group = texts[i : i + 64]
                chances = _chances(weights, counts, group, settings)
                begin = 0
                for words, tail in group:
                    label = classes_of(words, tail, counts.heads, counts.order)
                    if len(counts.known):
                        at = np.minimum(np.searchsorted(counts.known, words), len(counts.known) - 1)
                        hit = counts.known[at] == words
                    else:
                        at, hit = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
                    found = np.where(hit, logs[at] if len(logs) else 0.0, 0.0)
                    seen = int((counts.known_counts[at[hit]] > 0).sum()) if len(logs) else 0
                    own = float(chances[begin : begin + len(words)].sum()) + float(found[label >= heads].sum()) - float(masses[label].sum())
                    begin += len(words)
                    rare, times = np.unique(words[~hit], return_counts=True)
                    out.append((len(words), seen, float(found.sum()), own, rare.view(np.int64), times))
            columns = [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.float64()), pa.array([r[3] for r in out], pa.float64())]
            columns += [pa.array([r[4] for r in out], pa.list_(pa.int64())), pa.array([r[5] for r in out], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_text"), batch.column("held_out"), *columns], ["doc_id", "_text", "held_out", "n_tokens", "seen", "found", "own", "rare", "times"])
    return run


def _chances(weights: np.ndarray, counts: Counts, group: list[tuple[np.ndarray, np.ndarray]], settings: Settings) -> np.ndarray:
    """log10 probability of every token's class, for the texts one after the other."""
    rows = np.concatenate([features(w, settings.bits) for w, _ in group])
    labels = np.concatenate([classes_of(w, t, counts.heads, counts.order) for w, t in group])
    out = np.empty(len(labels))
    for i in range(0, len(labels), settings.batch):
        z = logits_of(weights, rows[i : i + settings.batch])
        z -= z.max(axis=1, keepdims=True)
        picked = z[np.arange(len(z)), labels[i : i + settings.batch]].astype(np.float64)
        out[i : i + settings.batch] = (picked - np.log(np.exp(z).sum(axis=1, dtype=np.float64))) / np.log(10.0)
    return out


def scores(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    work = documents(docs).select("doc_id", "text", F.xxhash64("text").alias("_text"), held_out(F.col("doc_id")).alias("held_out"))
    counts = token_counts(work, settings)
    summary = summarised(counts, settings)
    weights = train(work, summary, settings)
    shared = work.sparkSession.sparkContext.broadcast((weights, vars(summary)))
    kind = work.schema["doc_id"].dataType.simpleString()
    scored = stage(work.select("doc_id", "text", "_text", "held_out").mapInArrow(
        _scorer(shared, settings),
        f"doc_id {kind}, _text long, held_out boolean, n_tokens long, seen long, found double, own double, rare array<bigint>, times array<int>"))
    key = ["doc_id", "_text"]
    rare = scored.select(*key, F.explode_outer(F.arrays_zip("rare", "times")).alias("r")).select(*key, F.col("r.rare").alias("word"), F.col("r.times").alias("times")).where(F.col("word").isNotNull())
    looked = rare.join(counts.select("word", "trained"), "word", "left")
    trained = F.coalesce("trained", F.lit(0))
    terms = looked.select(*key, (F.col("times") * F.log10(trained + 0.5)).alias("l"), F.when(trained > 0, F.col("times")).otherwise(0).cast("long").alias("k"), F.lit(0).cast("long").alias("rows"))
    each = scored.select(*key, F.lit(0.0).alias("l"), F.lit(0).cast("long").alias("k"), F.lit(1).cast("long").alias("rows"))
    # rows repeated in full share their sums: divided by their number
    sums = terms.unionByName(each).groupBy(*key).agg((F.sum("l") / F.sum("rows")).alias("_l"), (F.sum("k") / F.sum("rows")).cast("long").alias("_k"))
    joined = join_null_safe(scored.drop("rare", "times"), sums, key)
    norm = float(np.log10(summary.tokens + 0.5 * (summary.distinct + 1)))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("seen") + F.col("_k")).alias("n_known"), F.lit(summary.tokens).cast("long").alias("train_tokens"),
        (F.col("found") + F.col("_l") - F.col("n_tokens") * norm).alias("base_score"), (F.col("own") + F.col("_l")).alias("score"))
