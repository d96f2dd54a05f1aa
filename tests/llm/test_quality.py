import duckdb
import pytest

from tests.llm.helpers import ODD_TEXTS, documents, empty, words
from tidemark.llm import quality
from tidemark.llm.oracle import quality_sql


def brute(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for x in windows:
        seen[x] = seen.get(x, 0) + 1
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_of_odd_texts(spark):
    texts = [*ODD_TEXTS, "a b c a b c", "a b c d a b c", "a a a a", "# $ a|b <c>\n#"]
    got = quality.quality_verdicts(documents(spark, texts)).collect()
    assert len(got) == len(texts)
    assert sorted(tuple(r[c] for c in STATS) for r in got) == sorted(brute(t) for t in texts)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_statistics_of_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = quality.quality_verdicts(docs).collect()
    assert {r.doc_id: tuple(r[c] for c in STATS) for r in got} == {i: brute(t) for i, t in texts.items()}


@pytest.fixture(scope="module")
def hosts(spark):
    """A host where a banner is in every document, one document is nothing but banner, and 40
    copies, edited in one word, of one document."""
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    banner = " ".join(f"banner{j}" for j in range(25))
    rows = [(i, f"{own(i)}\n{banner.upper() if i % 2 else banner}  ENDS", "h") for i in range(60)]
    rows += [(100, "\n".join([banner + " ends"] * 3), "h"), (101, "\n".join([banner + " ends"] * 3), "other")]
    copy = [" ".join(f"c{k}y{j}" for j in range(12)) for k in range(10)]
    rows += [(200 + i, "\n".join([*copy[:9], copy[9] + f" edit{i}"]), "h") for i in range(40)]
    rows += [(300 + i, own("same"), "h") for i in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_lines_above_the_host_limit_go(hosts):
    got = {r.doc_id: r for r in quality.quality_verdicts(hosts).collect()}
    assert all(got[i].kept and got[i].removed_words == 26 for i in range(60))
    assert not got[100].kept and got[100].removed_words == 78  # depleted
    assert got[101].removed_words == 0  # another host
    # copies are no boilerplate, edited or not
    assert all(got[200 + i].kept for i in range(40)) and all(got[300 + i].kept for i in range(50))


def test_cleaned_documents(hosts):
    got = {r.doc_id: r for r in quality.apply_quality(hosts).collect()}
    assert "banner0" not in got[5].text and got[5].text.startswith("w5x0")
    assert 100 not in got and 101 not in got or not got.get(101) or "banner0" in got[101].text


def test_columns_and_empty_table(spark):
    docs = documents(spark, ODD_TEXTS)
    out = quality.apply_quality(docs)
    assert out.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert quality.quality_verdicts(empty(spark)).count() == 0
    assert quality.apply_quality(empty(spark)).count() == 0


def test_a_host_of_mostly_boilerplate(spark):
    """Pages of 60, 75 and 85 percent common lines: the lines go; the last two kinds are depleted below 30 percent."""
    lines = [" ".join(f"nav{k}y{j}" for j in range(15)) for k in range(12)]
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    n_own = {0: 120, 1: 60, 2: 32}
    rows = [(i, "\n".join([*lines, own(i, n_own[i % 3])]), "h") for i in range(90)]
    got = {r.doc_id: r for r in quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].removed_words == 180 for i in range(90))
    assert all(got[i].kept == (i % 3 == 0) for i in range(90))


def test_copies_edited_in_many_lines_stay(spark):
    """Each of 60 copies has one word changed in three lines of ten: mostly frequent lines, nothing of their own."""
    copy = [[f"c{k}y{j}" for j in range(12)] for k in range(10)]
    edited = lambda i: [" ".join([*ws[:6], f"e{i}", *ws[7:]] if (k + i) % 10 < 3 else ws) for k, ws in enumerate(copy)]
    docs = spark.createDataFrame([(i, "\n".join(edited(i)), "h") for i in range(60)], "doc_id long, text string, source string")
    assert all(r.kept and r.removed_words == 0 for r in quality.quality_verdicts(docs).collect())


def same_as_sql(docs):
    """The verdicts, found equal to those of the registered SQL."""
    got = quality.quality_verdicts(docs)
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    cursor = connection.execute(quality_sql())
    names = [d[0] for d in cursor.description]
    rows = got.collect()
    assert sorted(repr([r[c] for c in names]) for r in rows) == sorted(map(repr, map(list, cursor.fetchall())))
    return {r.doc_id: r for r in rows}


def test_sql_of_all_rules(spark, hosts):
    assert sum(r.removed_words for r in same_as_sql(hosts).values()) > 1000
    lines = [" ".join(f"nav{k}y{j}" for j in range(15)) for k in range(12)]
    pages = [(i, "\n".join([*lines, " ".join(f"w{i}x{j}" for j in range(32 + i))]), "h" if i % 3 else None) for i in range(90)]
    assert sum(r.removed_words for r in same_as_sql(spark.createDataFrame(pages, "doc_id long, text string, source string")).values()) > 1000


@pytest.mark.parametrize("size", [100, 2500])
def test_the_limit_is_the_same_in_hosts_of_every_size(spark, size):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, own(i) + ("\nread more of this" if i < 45 else "\nseen in twenty" if i < 65 else ""), "h") for i in range(size)]
    got = quality.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: r.removed_words for r in got if r.removed_words} == {i: 4 for i in range(45)}


def test_numbers_in_lines(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    tail = lambda i: f"\nPage {i + 1} of 90, 2024-01-{i:02}\n{i} {i + 1} {i + 2}\nv{i} stays"
    got = same_as_sql(spark.createDataFrame([(i, own(i) + tail(i), "h") for i in range(90)], "doc_id long, text string, source string"))
    # numbers alone and numbers inside words tell lines apart
    assert all(r.removed_words == 5 for r in got.values())
