import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import LOWER, ODD_TEXTS, documents, empty
from tidemark.llm import phrases
from tidemark.llm.phrases import DoubleArray, Settings


def brute(rows, settings):
    """rows: (lang, text)"""
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            for k in range(1, settings.words + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= settings.least}
        inside = Counter()
        for p, a in often.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], a)
        found = []
        for p, a in often.items():
            if 100 * inside[p] >= settings.inside * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[: settings.first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def compare(docs, settings):
    got = sorted(tuple(r) for r in phrases.collocations(docs, settings).collect())
    assert got == brute([(r.lang, r.text) for r in docs.select("lang", "text").collect()], settings)
    return got


def sentences(n, seed):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "é", "Is", "big", "a\xa0b", "x1", "\x1c", "CITY", "of", "the", "ö" * 5]
    return ["".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", ". ", ", ", "\n"]) for _ in range(rng.randrange(60))) + " new york city of the" for _ in range(n)]


@pytest.mark.parametrize("settings", [Settings(least=5), Settings(least=3, shard=7, chunk=500, held=10, block=3, first=20, salts=3), Settings(least=2, words=2)])
def test_against_brute_force(spark, settings):
    docs = documents(spark, sentences(80, 3)).repartition(5)
    assert compare(docs, settings)


def test_odd_texts_and_repeated_rows(spark):
    docs = documents(spark, ODD_TEXTS + ["q r s t u"] * 40).repartition(3)
    assert compare(docs.union(docs), Settings(least=4))
    assert compare(docs, Settings(words=3))


def test_nothing(spark):
    assert phrases.collocations(empty(spark)).collect() == []
    assert phrases.collocations(documents(spark, ["only once", None])).collect() == []


@pytest.mark.parametrize("largest,k", [(3, 2), (50, 3), (5000, 4), (70_000, 2)])
def test_double_array_accepts_its_rows_only(largest, k):
    rng = np.random.default_rng(7)
    rows = np.unique(rng.integers(1, largest + 1, (3000, k)).astype(np.int32), axis=0)
    rows[: len(rows) // 3, 0] = 1  # one state with very many children
    rows = np.unique(rows, axis=0)
    rng.shuffle(rows)
    trie = DoubleArray(rows, largest)
    text = np.concatenate([rows.ravel(), [0], rng.integers(0, largest + 1, 5000), [0, 0]]).astype(np.int32)
    at, row = trie.accepted(text)
    where = {tuple(r): i for i, r in enumerate(rows.tolist())}
    expected = {i: where[w] for i in range(len(text) - k + 1) if (w := tuple(text[i : i + k].tolist())) in where}
    assert dict(zip(at.tolist(), row.tolist())) == expected
    assert trie.accepted(text[:1])[0].size == 0
