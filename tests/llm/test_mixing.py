from collections import defaultdict

import numpy as np

from tests.llm.helpers import ODD_TEXTS, documents, empty, words
from tidemark.llm import mixing


def test_targets():
    assert mixing.targets([1000, 1000, 1000]) == [2000.0, 5000 / 3, 2500 / 3]
    assert mixing.targets([100, 10_000]) == [200.0, 14_950.0]
    assert mixing.targets([0, 10]) == [0.0, 15.0] and mixing.targets([]) == []


def test_permutation_and_draws():
    for n in (1, 2, 3, 7, 64, 65, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5)) == list(range(n))
    quota, slots = np.array([500, 0, 300, 77]), 64
    total, seen = np.zeros(4, int), np.zeros(4, int)
    for shard in range(-(-877 // slots)):
        counts, before = mixing.shard_counts(quota, shard, slots, 1)
        assert (before == seen).all() and counts.sum() <= slots
        seen, total = seen + counts, total + counts
    assert (total == quota).all()


def test_draws_are_hypergeometric_at_every_size():
    """Means and spreads on both sides of 500 million, the size from which draws were once rounded."""
    for scale in (1, 1_000, 10**7, 10**11):
        colours = np.array([50, 30, 0, 20]) * scale
        total, drawn = int(colours.sum()), 40 * scale
        draws = np.array([mixing._half(colours, drawn, (7, i)) for i in range(400)], float)
        assert (draws.sum(axis=1) == drawn).all() and (draws <= colours).all() and (draws >= 0).all()
        share = colours / total
        spread = np.sqrt(drawn * share * (1 - share) * (total - drawn) / (total - 1))
        assert (np.abs(draws.mean(axis=0) - drawn * share) <= 5 * spread / 20 + 1e-9).all()
        assert (np.abs(draws.std(axis=0) - spread) <= 0.2 * spread + 1e-9).all()
    assert (mixing._half(np.array([3, 5]), 8, (1,)) == [3, 5]).all() and (mixing._half(np.array([3, 5]), 0, (1,)) == 0).all()


def test_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.taken(docs).collect()
    sizes = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    taken, aim = defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        aim[r.source] = r.target
    order = sorted(aim)
    by_source = defaultdict(int)
    for r in docs.collect():
        by_source[r.source] += sizes[r.doc_id]
    assert [aim[s] for s in order] == mixing.targets([by_source[s] for s in order])
    assert all(abs(taken[s] - aim[s]) <= 130 for s in order)
    again = {(r.doc_id, r.taken) for r in mixing.taken(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_words_of_the_mix(spark):
    texts = [f"d{i} " + " ".join(f"d{i}w{j}" for j in range(200)) for i in range(30)]
    docs = documents(spark, texts, first=10)
    rows, _, _ = mixing.mixed(docs)
    for r in mixing.with_text(rows, docs).collect():
        assert len(r.words) == r.n_words and len({w.split("w")[0] for w in r.words}) == 1
    taken = sum(r.taken for r in mixing.taken(docs).collect())
    assert sum(r.n_words for r in rows.collect()) == taken


def test_odd_texts(spark):
    docs = documents(spark, ODD_TEXTS)
    rows = mixing.taken(docs).collect()
    assert sorted(r["size"] for r in rows) == sorted(len(words(t)) for t in ODD_TEXTS)
    assert all(r.taken == 0 for r in rows if r["size"] == 0) and all(r.taken <= 2 * r["size"] for r in rows)
    assert mixing.taken(empty(spark)).count() == 0
