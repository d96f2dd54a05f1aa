"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to ``longest``-grams of the lower-cased text, everything that is no letter as
one blank, hashed to ``2 ** bits`` columns; 1 + log of the count, times the inverse document
frequency, scaled to length 1.  Document frequencies are counted over all training documents.
The classifier is fitted by follow-the-regularised-leader with L1 and L2 penalties, in one task, on a
sample of distinct texts, ``per_language`` of every language at most but for chance, chosen by hash.  A
fifth of the sample is kept from the fit and sets the temperature that calibrates the scores.

Every document is predicted from its whole text in Arrow batches; the model, ``2 ** bits``
weights a language, goes with the tasks.

Defined cases: ``und`` with score 0 for a null text, a text without a letter, and for all texts
if nothing can be learned; one learned language is always predicted, with score 1; a null
``doc_id`` counts as the empty string in the split; repeated rows are predicted each.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_by_value, stage

ship_by_value(__name__)

UNKNOWN = "und"
#: letters, and numbers such as fractions and Roman numerals, which are told apart afterwards
_LETTER = re.compile(r"[^\W\d_]")
#: letters of the first code points, by code point; all from here on count as letters but blanks
_ASCII = np.array([chr(c).isalpha() for c in range(128)])
_LATIN = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(128, 768)])


@dataclass(frozen=True)
class Settings:
    bits: int = 14
    longest: int = 3
    per_language: int = 2000
    epochs: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def counts(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Columns and counts of the text's n-grams."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    low, mid = codes < 128, (codes >= 128) & (codes < 768)
    letter = np.ones(len(codes), bool)
    letter[low] = _ASCII[codes[low]]
    letter[mid] = _LATIN[codes[mid] - np.uint64(128)]
    codes = np.where(letter, codes, np.uint64(32))
    blank = codes == 32
    codes = codes[~(blank & np.concatenate([[True], blank[:-1]]))] if len(codes) else codes
    codes = np.concatenate([[np.uint64(32)], codes, [np.uint64(32)]]).astype(np.uint64)
    shift, parts, gram = np.uint64(64 - settings.bits), [], np.zeros(len(codes), np.uint64)
    for n in range(1, settings.longest + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        gram = gram[:m] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
        parts.append(((gram ^ (gram >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15)) >> shift)
    total = np.bincount(np.concatenate(parts).astype(np.int64), minlength=1 << settings.bits)
    columns = np.flatnonzero(total)
    return columns, total[columns]


def weighted(text: str, idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    columns, n = counts(text, settings)
    values = (1.0 + np.log(n)) * idf[columns]
    return columns, values / max(float(np.sqrt(values @ values)), 1e-12)


def _frequencies(settings: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << settings.bits, np.int64), 0
        for batch in batches:
            for value in batch.column("text"):
                total[counts(value.as_py(), settings)[0]] += 1
                rows += 1
        at = np.flatnonzero(total)
        # the number of documents rides along as column -1
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], rows), pa.int64())], ["at", "n"])
    return count


def inverse_frequencies(texts: DataFrame, settings: Settings) -> np.ndarray:
    rows = texts.mapInArrow(_frequencies(settings), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    found, documents = np.zeros(1 << settings.bits), 0
    for at, n in zip(rows["at"], rows["n"], strict=True):
        if at < 0:
            documents = n
        else:
            found[at] = n
    return np.log((1.0 + documents) / (1.0 + found)) + 1.0


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, settings: Settings) -> np.ndarray:
    """Weights by column and class; rows are (columns, values, class), passed over in order."""
    z, n = np.zeros((1 << settings.bits, classes)), np.zeros((1 << settings.bits, classes))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= settings.l1, 0.0, -(zs - np.sign(zs) * settings.l1) / ((settings.beta + np.sqrt(ns)) / settings.alpha + settings.l2))

    for _ in range(settings.epochs):
        for columns, values, label in rows:
            zs, ns = z[columns], n[columns]
            w = weights(zs, ns)
            error = _softmax(values @ w)
            error[label] -= 1.0
            gradient = values[:, None] * error[None, :]
            squared = gradient * gradient
            z[columns] = zs + gradient - (np.sqrt(ns + squared) - np.sqrt(ns)) / settings.alpha * w
            n[columns] = ns + squared
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The one of a fine grid under which the labels are likeliest."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _fitter(names: list[str], idf: np.ndarray, settings: Settings):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat(list(frames)).sort_values(["h", "lang", "text"], kind="stable")
        number = {x: i for i, x in enumerate(names)}
        rows = [(*weighted(t, idf, settings), number[x]) for t, x in zip(sample["text"], sample["lang"], strict=True)]
        apart = sample["h"].to_numpy() % 5 == 0
        w = fit([r for r, a in zip(rows, apart, strict=True) if not a], len(names), settings)
        kept = [r for r, a in zip(rows, apart, strict=True) if a]
        logits = np.array([v @ w[c] for c, v, _ in kept]).reshape(len(kept), len(names))
        t = temperature(logits, np.array([y for *_, y in kept], np.int64))
        yield pd.DataFrame({"weights": [w.astype(np.float32).tobytes()], "temperature": [t]})
    return run


@dataclass(frozen=True)
class Model:
    names: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    settings: Settings


def sample(rows: DataFrame, settings: Settings) -> tuple[DataFrame, list[str]]:
    """Distinct texts by language, about ``per_language`` of each at most, staged, and the languages.

    ``rows`` holds ``text, lang, h``.  The share of a language follows from its distinct texts, and
    a text that any number of rows repeat is one row of the sample.
    """
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count_distinct("h").alias("n")).collect()}
    share = [F.when(F.col("lang") == x, min(2**63 - 1, int(settings.per_language / n * 2**63))) for x, n in sorted(totals.items())]
    chosen = rows.where(F.col("h") <= F.coalesce(*share)) if share else rows.limit(0)
    return stage(chosen.dropDuplicates(["lang", "text"])), sorted(totals)


def train(docs: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Learns from text and lang of rows with a lang; None if there are none."""
    rows = docs.where(F.col("lang").isNotNull()).select(F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    chosen, names = sample(rows, settings)
    if not names:
        return None
    idf = inverse_frequencies(rows.select("text"), settings)
    row = chosen.coalesce(1).mapInPandas(_fitter(names, idf, settings), "weights binary, temperature double").collect()[0]
    return Model(names, idf, np.frombuffer(row["weights"], np.float32).reshape(-1, len(names)).astype(np.float64), row["temperature"], settings)


def _predictor(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for value in batch.column("text"):
                text = value.as_py()
                if model is None or not text or not any(m[0].isalpha() for m in _LETTER.finditer(text)):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                columns, values = weighted(text, model.idf, model.settings)
                p = _softmax(values @ model.weights[columns] / model.temperature)
                best = int(p.argmax())
                langs.append(model.names[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    work = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = work.schema["doc_id"].dataType.simpleString()
    return work.mapInArrow(_predictor(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row: ``doc_id, held_out, lang_pred, score``, learned from the rows not held out."""
    return predict(docs, train(docs.where(~held_out(F.col("doc_id"))), settings))
