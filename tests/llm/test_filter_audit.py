import random
from collections import Counter
from itertools import permutations

import pytest

from tests.llm.helpers import ODD_TEXTS, documents, empty
from tidemark.llm import filter_audit
from tidemark.llm.filter_audit import RadixTrie, Settings, common_length, shard_bounds, shard_of

SMALL = Settings(shard_bytes=2000, sampled=8, prefix=12)


def failed(text):
    w = (text or "").encode().split()
    out = set()
    if len(w) < 50:
        out.add("A")
    if 100 * len(set(w)) < 65 * len(w):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text or "") > 5 * len(text or ""):
        out.add("C")
    if set("#$%&*|") & set(text or ""):
        out.add("D")
    return out


def brute(rows, labels):
    """rows: (doc_id, text, source)"""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    judged = []
    for i, text, source in rows:
        f = failed(text)
        if i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows):
            f.add("E")
        judged.append((source or "", f, i in good, i in toxic))
    parts, shapley = {s for s, *_ in judged}, Counter()
    for order in permutations("ABCDE"):
        for s, f, _, _ in judged:
            if first := next((x for x in order if x in f), None):
                shapley[s, first] += 1
    out = []
    for part in parts:
        mine = [x for x in judged if x[0] == part]
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [(g, t) for _, f, g, t in mine if x in f and not f & before]
                out.append((part, "".join(order), step,
                    sum(not f & (before | {x}) for _, f, _, _ in mine), len(here),
                    sum(x in f and bool(f & before) for _, f, _, _ in mine), sum(f == {x} for _, f, _, _ in mine),
                    sum(g for g, _ in here), sum(t for _, t in here), shapley[part, x]))
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def compare(spark, docs, labels, settings=Settings()):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.audit(docs, table, settings).select(COLUMNS).collect())
    assert got == brute([(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()], labels)


def varied(n, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.5:
            texts.append("the same long beginning of every such text " * 2 + f"end {rng.randrange(20)}")
        else:
            length = rng.choice([3, 60, 80])
            texts.append(" ".join(rng.choice(["Aa", "#b", "c", f"w{rng.randrange(500)}", "É", f"v{rng.randrange(99)}"]) for _ in range(length)))
    return texts


def test_odd_texts(spark):
    compare(spark, documents(spark, ODD_TEXTS * 2), [(0, 1, 0), (0, 0, 1), (5, None, 1), (99, 1, 1), (None, 1, 1)])


@pytest.mark.parametrize("settings", [Settings(), SMALL])
def test_varied_texts_over_shards(spark, settings):
    docs = documents(spark, varied(300, 1)).repartition(7)
    compare(spark, docs, [(i, i % 2, int(i % 5 == 0)) for i in range(0, 300, 3)], settings)


def test_repeated_rows_and_a_third_of_all_rows_with_one_text(spark):
    docs = documents(spark, varied(100, 2) + ["hot " * 60] * 50).repartition(5)
    compare(spark, docs.union(docs.limit(40)), [(120, 1, 1)], SMALL)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty(spark), labels).collect() == []
    compare(spark, documents(spark, ["a b"]), [])


def test_trie_holds_the_smallest_id_of_every_text():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode() for _ in range(500)]
    trie = RadixTrie()
    at = [trie.insert(t, k) for t, k in zip(texts, rng.sample(range(500), 500))]
    trie = RadixTrie()
    keys = rng.sample(range(500), 500)
    at = [trie.insert(t, k) for t, k in zip(texts, keys)]
    # a node may be split after it was given out, but terminals stay
    for text in set(texts):
        same = [i for i, t in enumerate(texts) if t == text]
        assert len({at[i] for i in same}) == 1
        assert trie.least[at[same[0]]] == min(keys[i] for i in same)
    assert len({at[texts.index(t)] for t in set(texts)}) == len(set(texts))


def test_bounds_and_shards():
    assert common_length(b"abcd", b"abxd") == 2 and common_length(b"", b"a") == 0 and common_length(b"ab", b"ab") == 2
    sample = [(b"%05d" % i, 1) for i in range(100)]
    bounds = shard_bounds(sample, 10)
    assert len(bounds) == 9 and bounds == sorted(bounds)
    assert all(len(b) <= 5 for b in bounds)
    once = {b: 1 for b in bounds}
    spread = Counter(shard_of(t, bounds, once) for t, _ in sample)
    assert len(spread) == 10 and max(spread.values()) <= 20
    alike = shard_bounds([(b"x" * 12, 1)] * 90 + [(b"a", 1)] * 10, 10)
    many = Counter(shard_of(b"x" * 12 + b"%d" % i, alike, Counter(alike)) for i in range(1000))
    assert len(many) >= 8 and max(many.values()) < 300
