import math
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.helpers import LOWER, ODD_TEXTS, crc, documents, empty, words
from tidemark.llm import lm


def brute(rows):
    split = [(i, [*words((t or "").translate(LOWER)), None]) for i, t in rows]
    c = Counter(w for i, ws in split if crc(i, 5) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((
        (str(i), crc(i, 5) == 1, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for i, ws in split))


def compare(docs, settings):
    rows = lm.scores(docs, settings).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert [x[:5] for x in got] == [x[:5] for x in expected]
    assert np.allclose([x[5] for x in got], [x[5] for x in expected], rtol=1e-9, atol=1e-9)
    return rows


def test_odd_texts(spark):
    assert all(math.isfinite(r.score) for r in compare(documents(spark, [*ODD_TEXTS, *ODD_TEXTS[-2:]]), lm.Settings(known_words=2)))
    assert lm.scores(empty(spark)).count() == 0


def test_beats_the_base_on_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet".replace("sf0.001", "sf0.01"))
    rows = [r for r in compare(docs, lm.Settings(known_words=3000)) if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_repeated_rows_share_their_score(spark):
    docs = spark.createDataFrame([(2, "a b c"), (2, "a b c"), (3, "a d"), (2, "other")], "doc_id long, text string")
    rows = compare(docs, lm.Settings(known_words=0))
    assert len({(r.n_tokens, r.base_score, r.score) for r in rows if r.doc_id == 2 and r.n_tokens == 4}) == 1


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    settings = lm.Settings(bits=6)
    words_, tail = lm.tokens("a b c a", settings.tails)
    weights = rng.normal(size=(65, 30)).astype(np.float32)
    p = lm._softmax(lm.logits_of(weights, lm.features(words_, 6)))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5) and len(words_) == 5


def test_training_learns_a_pattern(spark):
    """After "x" comes "y", after "p" comes "q": the pairs are likelier than the single words."""
    docs = spark.createDataFrame([(i, "x y " * 50 + "p q " * 50) for i in range(400)], "doc_id long, text string")
    rows = [r for r in lm.scores(docs, lm.Settings(batch=512)).collect() if r.held_out]
    assert rows and all(r.score > 0.3 * r.base_score for r in rows)


def test_production_settings_learn_a_share_however_dealt(spark):
    """After "x" comes "y" nine times of ten, else "z", on default settings in 32 small partitions.

    The best score of a text is -14 (100 choices of 0.141 each); even chances give -30.
    """
    rng = np.random.default_rng(3)
    texts = [(i, " ".join("x y" if u < 0.9 else "x z" for u in rng.random(100))) for i in range(1600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(32)
    rows = [r.score for r in lm.scores(docs).collect() if r.held_out]
    assert rows and np.mean(rows) > -20


def test_a_step_sums_gradients_by_weight_row():
    rng = np.random.default_rng(2)
    rows, target = rng.integers(0, 8, (50, 4)), rng.integers(0, 5, 50)
    weights, squares, uses = rng.normal(size=(9, 5)).astype(np.float32), np.ones((9, 5), np.float32), np.zeros(9, np.float32)
    error = lm._softmax(lm.logits_of(weights, rows)) - np.eye(5)[target]
    gradient = np.zeros((9, 5))
    for e, used in zip(error, rows, strict=True):
        for at in (*used, 8):
            gradient[at] += e / 50
    expected = weights - 0.3 * gradient / (np.sqrt(1 + gradient**2) + 1e-5)
    lm._steps(weights, squares, uses, rows, target, 0.3)
    assert np.allclose(weights, expected, atol=1e-5) and np.allclose(squares, 1 + gradient**2, atol=1e-5)
    assert uses.tolist() == [*np.bincount(rows.ravel(), minlength=8), 50]


def test_steps_follow_the_tokens(monkeypatch):
    """A task of 40004 tokens takes five steps on default settings, from the squares that it is given."""
    seen = []

    def step(weights, squares, uses, rows, target, step):
        seen.append((len(target), float(squares.min())))
        uses += 1

    monkeypatch.setattr(lm, "_steps", step)
    settings = lm.Settings()

    class Shared:
        value = (np.zeros((9, 24), np.float32), np.full((9, 24), 2, np.float32), np.zeros(0, np.uint64), np.zeros(0, np.int64))

    texts = pa.RecordBatch.from_arrays([pa.array(["a " * 10_000] * 4)], ["text"])
    assert len(list(lm._trainer(Shared, settings)(iter([texts])))) == lm._CHUNKS
    assert [n for n, _ in seen] == [8192] * 4 + [40_004 - 4 * 8192] and {s for _, s in seen} == {2.0}
