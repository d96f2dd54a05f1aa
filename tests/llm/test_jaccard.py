import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import LOWER, ODD_TEXTS, documents, empty, words
from tidemark.llm import jaccard
from tidemark.llm.jaccard import Settings, shingle_sets


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3)) if w}


def brute(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sets, by = [shingles(t) for _, t in rows], defaultdict(list)
    for n, s in enumerate(sets):
        for m in {m for x in s for m in by[x]}:
            common = len(s & sets[m])
            if 100 * common >= 85 * (len(s) + len(sets[m]) - common):
                parent[find(n)] = find(m)
        for x in s:
            by[x].append(n)
    groups = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        groups[find(n)].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((i, len(sets[n]), least[find(n)]) for n, (i, _) in enumerate(rows)), key=repr)


def compare(docs, settings=Settings()):
    got = sorted((tuple(r) for r in jaccard.linked_components(docs, settings).collect()), key=repr)
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got == expected
    return len({c for _, _, c in got})


def changed(rng, text, edits):
    w = text.split()
    for i in rng.sample(range(len(w)), min(edits, len(w))):
        w[i] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def text_of(rng, n):
    return " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))


def test_odd_texts(spark):
    compare(documents(spark, ODD_TEXTS * 2))
    assert jaccard.linked_components(empty(spark)).collect() == []


def test_shingles_are_the_sets(spark):
    rng = random.Random(1)
    texts = ["", "a", "a b c", "a b c d", "a b c d e a b c d e", "é ü 😀 x y", *(" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(50))]
    for at_once in (1, 50, 10**6):
        got = shingle_sets([t.encode() for t in texts], 4, at_once)
        by = defaultdict(set)
        for t, s in zip(texts, got):
            assert len(s) == len(shingles(t)) and (np.diff(s.astype(object)) > 0).all()
            by[frozenset(shingles(t))].add(s.tobytes())
        assert all(len(v) == 1 for v in by.values())


@pytest.mark.parametrize("settings", [Settings(), Settings(bucket=50, at_once=300), Settings(sampled=1)])
def test_families_at_every_similarity(spark, settings):
    """Copies with 0 to 8 changed words, growing lengths and shared passages around the border."""
    rng = random.Random(2)
    texts, passage = [], text_of(rng, 60)
    for n in (3, 5, 9, 30, 120):
        for _ in range(6):
            base = text_of(rng, n)
            texts += [base.upper() if rng.random() < 0.2 else base, base.replace(" ", "\n")]
            texts += [changed(rng, base, k) for k in range(8)]
            texts += [base + " " + text_of(rng, k) for k in (1, 3, n // 8 + 1)]
            last = base
            for _ in range(4):  # a chain
                last = changed(rng, last, 1 + n // 60)
                texts.append(last)
    texts += [passage + " " + text_of(rng, k) for k in range(1, 40)]
    rng.shuffle(texts)
    assert compare(documents(spark, texts).repartition(9), settings) > 100


def test_large_group_of_near_copies_costs_no_pairs(spark):
    """Links confirmed grow with the group, not with its square; a third of all rows are its copies."""
    rng = random.Random(3)
    sizes = []
    for n in (60, 120, 240):
        base = text_of(rng, 100)
        texts = [base] + [changed(rng, base, 1 + i % 4) for i in range(n)] + [base] * (n // 2) + [text_of(rng, 30) for _ in range(20)]
        docs = documents(spark, texts).repartition(5)
        compare(docs)
        sizes.append(jaccard.links(jaccard.candidates(docs)[1]).count())
    assert sizes[2] < 5.5 * sizes[0] and sizes[0] > 10


def test_a_batch_of_texts_is_hashed_in_little_memory():
    """Beside the texts, a task holds the sampled parts of their sets and one portion being hashed."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(words[j] for j in rng.integers(0, 5000, 1500)) for _ in range(1500)]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([b"%016d" % i for i in range(n)]), pa.array(range(n)), pa.array(texts)], ["doc_id", "node", "key", "text"])
    jaccard._known.clear()
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in jaccard._posted(jaccard.Settings(), 4)([batch]))
        posted = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        sets = [s for b in jaccard._sets(jaccard.Settings())([batch]) for s in b.column("cells")]
        made = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > n and len(sets) == n
    assert sets[7].as_py() == jaccard.shingle_sets([texts[7].encode()], 4)[0].view(np.int64).tolist()
    assert posted < 70e6 and made < 50e6
