import re

from tests.llm.helpers import ODD_TEXTS, documents, empty, sha
from tidemark.llm import pii


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def number(v):
    return re.sub("[^0-9]", "", v)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 14 <= len(number(v)) <= 19 and luhn(number(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= len(number(v)) <= 15),
]


def brute(text):
    out = []
    for o, (kind, pattern, ok) in enumerate(BASE):
        if kind == "email" and "@" not in (text or ""):
            continue
        out += [(m.start(), o, m.end(), kind) for m in re.finditer(pattern, text or "") if ok(m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


TEXTS = [
    *ODD_TEXTS, "mail a@b.com_x@d.e, x.34@mail7.example.com.", "1.2.3.400 97.51.17.173 0097.0.0.001 1.2.3.4.5.6.7.8.9",
    "+1 (017) 555-7713 and 4111 1111 1111 1111, 4111-1111-1111-1112", "😀é a@b.c +49 30 123456", " ".join(f"u{i}@x.org" for i in range(700)),
    "9" * 30_000, "1." * 5_000, "@" * 1000, "+" * 1000,
]


def test_base_spans(spark):
    got = pii.digest(pii.personal_data(documents(spark, TEXTS))).collect()
    assert sorted(r.base_sha256 for r in got) == sorted(sha(brute(t)) for t in TEXTS)


def test_base_spans_of_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.base_sha256 for r in pii.digest(pii.personal_data(docs)).collect()}
    assert got == {r.doc_id: sha(brute(r.text)) for r in docs.collect()}


def test_added_kinds_need_checksum_or_context(spark):
    texts = [
        "pay DE89 3704 0044 0532 0130 00 now", "pay DE88 3704 0044 0532 0130 00 now", "GB82WEST12345698765432",
        "ssn 123-45-6789", "part 123-45-6789", "call (555) 123-4567", "see (555) 123-4567", "call +1 (555) 123-4567",
        "my bank account DE88 3704 0044 0532 0130 00",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.spans for r in pii.digest(pii.personal_data(rows)).orderBy("doc_id").collect()]
    assert got == ["iban:4:31", "", "iban:0:22", "national:4:15", "", "local:5:19", "", "phone:5:22", ""]


def test_empty_table_and_no_python(spark):
    assert pii.digest(pii.personal_data(empty(spark))).count() == 0
    plan = pii.personal_data(documents(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
