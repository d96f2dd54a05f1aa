import random
from collections import Counter, defaultdict

import numpy as np

from tests.llm.helpers import ODD_TEXTS, documents, empty
from tidemark.llm import neardup


def shingles(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)) if w)


def jaccard(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def brute(rows):
    """Classes by all pairs that share a shingle; equal texts without words are one class."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    bags, by = [shingles(t) for _, t in rows], defaultdict(list)
    for n, bag in enumerate(bags):
        near = {m for s in bag for m in by[s]} if bag else set(by[None])
        for m in near:
            if find(m) != find(n) and jaccard(bag, bags[m]) >= 0.8:
                parent[find(n)] = find(m)
        for s in bag or [None]:
            by[s].append(n)
    groups = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        groups[find(n)].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((i, least[find(n)]) for n, (i, _) in enumerate(rows)), key=repr)


def compare(docs):
    got = sorted((tuple(r) for r in neardup.near_duplicates(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_similarity_and_signature():
    rng = random.Random(5)
    a = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for edits in (0, 3, 8):
        b = list(a)
        for k in rng.sample(range(200), edits):
            b[k] = f"e{k}"
        x, y = neardup.cells(" ".join(a)), neardup.cells(" ".join(b))
        true = jaccard(shingles(" ".join(a)), shingles(" ".join(b)))
        assert neardup.similarity(x, y) == true
        assert abs(np.mean(neardup.signature(x, 256) == neardup.signature(y, 256)) - true) < 0.13
    twice, thrice = "a b c d e " * 20, "a b c d e " * 30
    assert neardup.similarity(neardup.cells(twice.strip()), neardup.cells(thrice.strip())) == jaccard(shingles(twice), shingles(thrice))


def test_odd_texts(spark):
    docs = documents(spark, [*ODD_TEXTS, "A b  c d e f", "a b c d e f\n", "x y", "X y"])
    compare(docs)
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({c for _, c in brute([(r.doc_id, r.text) for r in docs.collect()])})
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_group_of_edited_copies(spark):
    """Copies with few and many edits of one text, where most pairs of copies are under the
    threshold and the original is what holds them together."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    rows = [(5000, " ".join(base))]
    for i in range(250):
        w = list(base)
        for k in rng.sample(range(150), rng.choice([1, 2, 3, 3, 4, 6, 9])):
            w[k] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    rows += [(9000 + i, " ".join(f"z{i}y{j}" for j in range(80))) for i in range(120)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_chain(spark):
    """Each like the next, the ends unlike."""
    rows = [(i, " ".join(f"c{j}" for j in range(4 * i, 4 * i + 100))) for i in range(12)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_a_table(spark, sf_dir):
    compare(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_links_sent_grow_with_the_group(spark):
    """Copies of one text with three words of 150 changed, more of them than a block holds: no pairs are sent."""
    settings, sent = neardup.Settings(block=32), []
    for n in (50, 100, 200):
        rng = random.Random(9)
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        texts = [" ".join(base)]
        for i in range(n):
            w = list(base)
            for k in rng.sample(range(150), 3 + i % 3):
                w[k] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(w))
        docs = documents(spark, texts).repartition(3)
        got = sorted((tuple(r) for r in neardup.near_duplicates(docs, settings).collect()), key=repr)
        assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        sent.append(len({c for _, c in got}))
    assert sent == sorted(sent)
