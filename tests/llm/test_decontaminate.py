import re

from tests.llm.helpers import LOWER, ODD_TEXTS, documents, empty, sha
from tidemark.llm import decontaminate

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(text, items):
    windows = {}
    for item, said in items:
        w = terms(said)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    w, hit, found = terms(text), set(), set()
    for n in {len(x) for x in windows}:
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found |= windows[tuple(w[i : i + n])]
    return (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))


def compare(docs, benchmark):
    got = [tuple(r)[1:] for r in decontaminate.digest(decontaminate.contamination(docs, benchmark)).collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    assert sorted(got) == sorted(brute(r.text, items) for r in docs.collect())


def test_small_cases(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    items = spark.createDataFrame([(1, passage), (2, passage + " tail"), (10, "short item"), (3, None), (4, ""), (5, "É. é!"), (6, "a a a a a a a a a a a a")], "item_id long, text string")
    texts = [
        *ODD_TEXTS, f"before {passage.upper()} after", " ".join(passage.split()[:9]), " ".join(passage.split()[2:12]), "Short, ITEM! short item", "É é", "é é",
        "a " * 30, passage.replace("p5", "p5 gap"), passage, passage,
    ]
    compare(documents(spark, texts), items)


def test_a_table(spark, sf_dir):
    compare(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def test_proximity_is_no_hit(spark):
    passage = " ".join(f"p{i}" for i in range(10))
    docs = spark.createDataFrame([(1, passage.replace("p5", "gap p5")), (2, passage)], "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontaminate.contamination(docs, items).collect()}
    assert got[2] == (10, 0) and got[1][0] == 0


def test_filter_and_empty_tables(spark):
    docs = documents(spark, [*ODD_TEXTS, "a b c d e f g h i j k"])
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    out = decontaminate.decontaminate(docs, items)
    assert out.columns == docs.columns and out.count() == len(ODD_TEXTS)
    assert decontaminate.contamination(empty(spark), items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == len(ODD_TEXTS) + 1
