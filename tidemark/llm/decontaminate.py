"""Benchmark passages in training documents, by a distributed positional inverted index.

1.  Every benchmark item becomes windows of ``width`` consecutive words (a shorter item is one
    window), each distinct window once.
2.  One pass counts the windows' terms over all documents; the two rarest terms of a window are
    its anchors.  A window with a term that no document has cannot occur and goes.
3.  A second pass stores the postings (document, position, term) of all anchor terms.
4.  Postings less their anchor's offset are starts; where both lists agree on (document, window,
    start) the window may begin.  The words there are compared, which makes a phrase match.
5.  Where the lists differ by ``slack`` words at most and most of the window's words are
    around, it is a proximity match; these are returned, but do not count as hits.

Only the anchors' postings are stored: the full index would be larger than the corpus.  Terms
are 64-bit hashes.  Rows are grouped by document, never by term or window, so a passage that a
third of the documents share is no hot group.  DataFrame functions only.

Defined cases: null texts have no words; rows with a null ``doc_id`` are documents, null
``item_id`` marks words as hit but is not listed; repeated rows each get the same result;
an empty benchmark leaves every document clean; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, join_counted, join_null_safe, lower_ascii, stage, text_of

# What separates words, before and after lower case.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: of a window's words that must be around for a proximity match
NEAR_SHARE = 0.8

_KEY = ["doc_id", "_text"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATOR, -1), "")


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).select("doc_id", F.xxhash64("text").alias("_text"), "text")


def windows(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``item_id, _window, n, words``: the windows of every item."""
    items = benchmark.select("item_id", words_of(text_of()).alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - width + 1, F.lit(1)))
    each = items.select("item_id", "_w", F.explode(starts).alias("_at")).select("item_id", F.slice("_w", F.col("_at"), width).alias("words"))
    return each.select("item_id", F.xxhash64(F.array_join("words", " ")).alias("_window"), F.size("words").alias("n"), "words").dropDuplicates(["item_id", "_window"])


def anchors(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``_term, _window, offset, n_anchors``: the two rarest terms of every window, its ``offset`` in it."""
    terms = distinct.select("_window", F.posexplode(F.transform("words", lambda w: F.xxhash64(w))).alias("offset", "_term"))
    asked = stage(terms.select("_term").distinct())
    hashed = _keyed(docs).select(F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("_h"))
    seen = hashed.select(F.explode_outer("_h").alias("_term"))
    counts = stage(join_counted(seen, asked, ["_term"], "left_semi").groupBy("_term").agg(F.count(F.lit(1)).alias("_c")))
    rated = terms.join(counts, "_term", "left").select("_window", F.struct(F.coalesce("_c", F.lit(0)).alias("c"), "offset", "_term").alias("_t"))
    lists = rated.groupBy("_window").agg(F.sort_array(F.collect_list("_t")).alias("_ts")).where(F.col("_ts")[0]["c"] > 0)
    two = lists.select("_window", F.slice("_ts", 1, 2).alias("_ts"))
    return two.select("_window", F.size("_ts").alias("n_anchors"), F.posexplode("_ts").alias("k", "_t")).select("_window", "n_anchors", "k", "_t.offset", "_t._term")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id, _text, position, _term`` of the given terms; ``terms`` is staged and distinct."""
    hashed = _keyed(docs).select(*_KEY, F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("_h"))
    placed = hashed.select(*_KEY, F.posexplode_outer("_h").alias("position", "_term"))
    return join_counted(placed, terms, ["_term"], "left_semi")


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int = 3) -> tuple[DataFrame, DataFrame]:
    """Phrase and proximity matches by document, and the staged windows.

    The first holds ``doc_id, _text`` (a hash of the text), ``phrases array<(start, n, _window)>``
    and ``near array<(start, n, _window)>`` of documents with at least one match; the second
    ``item_id, _window, n, words``.
    """
    listed = stage(windows(benchmark, width))
    distinct = listed.select("_window", "n", "words").dropDuplicates(["_window"])
    asked = stage(anchors(docs, distinct))
    terms = stage(asked.select("_term").distinct())
    index = stage(postings(docs, terms))
    starts = join_counted(index, asked, ["_term"]).select(*_KEY, "_window", "k", "n_anchors", (F.col("position") - F.col("offset")).alias("start"))
    exact = (
        starts.where("start >= 0").groupBy(*_KEY, "_window", "start", "n_anchors").agg(F.count_distinct("k").alias("_k"))
        .where("_k = n_anchors").select(*_KEY, "_window", "start", F.lit(True).alias("exact"))
    )
    span = slack + 1
    bucketed = starts.where("n_anchors = 2").withColumn("_b", F.explode(F.array(F.floor(F.col("start") / span), F.floor(F.col("start") / span) + 1)))
    lowest = lambda k: F.min(F.when(F.col("k") == k, F.col("start")))
    close = (
        bucketed.groupBy(*_KEY, "_window", "_b").agg(lowest(0).alias("_a"), lowest(1).alias("_z"))
        .where((F.col("_a") != F.col("_z")) & (F.abs(F.col("_a") - F.col("_z")) <= slack))
        .select(*_KEY, "_window", F.greatest(F.least("_a", "_z"), F.lit(0)).alias("start"), F.lit(False).alias("exact")).distinct()
    )
    found = join_counted(exact.unionByName(close), stage(distinct), ["_window"])
    lists = found.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "n", "_window", "exact", F.when(~F.col("exact"), F.col("words")).alias("words"))).alias("_c"))
    candidates = stage(lists)
    few = candidates.select(*_KEY)
    # the texts of the candidates only, then the candidates to them; both sides agree on the key
    wanted = _with_texts(docs, candidates, few.count())
    checked = wanted.select(
        *_KEY,
        F.filter("_c", lambda c: c["exact"] & (F.xxhash64(F.array_join(F.slice("_w", c["start"] + 1, c["n"]), " ")) == c["_window"])).alias("_p"),
        F.filter("_c", lambda c: ~c["exact"] & (
            F.size(F.array_intersect(F.slice("_w", c["start"] + 1, c["n"] + slack), c["words"])) >= NEAR_SHARE * F.size(F.array_distinct(c["words"])))).alias("_n"),
    )
    plain = lambda c: F.struct(c["start"].alias("start"), c["n"].alias("n"), c["_window"].alias("_window"))
    hits = checked.select(*_KEY, F.transform("_p", plain).alias("phrases"), F.transform("_n", plain).alias("near"))
    apart = F.filter("near", lambda c: ~F.exists("phrases", lambda p: (p["_window"] == c["_window"]) & (F.abs(p["start"] - c["start"]) <= slack)))
    return hits.select(*_KEY, "phrases", apart.alias("near")).where((F.size("phrases") > 0) | (F.size("near") > 0)), listed


def _with_texts(docs: DataFrame, candidates: DataFrame, count: int) -> DataFrame:
    """Candidates with the words of their document, one row per distinct document."""
    small = count <= 100_000  # keys of three numbers each
    keys = candidates.select(*_KEY)
    texts = join_null_safe(_keyed(docs), F.broadcast(keys) if small else keys, _KEY).dropDuplicates(_KEY)
    return join_null_safe(texts.select(*_KEY, words_of(F.col("text")).alias("_w")), candidates, _KEY)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """One row per row: ``doc_id, n_words, n_hit, n_items, items`` (item ids as strings, sorted), ``n_near, contaminated``."""
    found, listed = matches(docs, benchmark, width)
    found = stage(found)
    ids = listed.where(F.col("item_id").isNotNull()).select("_window", F.col("item_id").cast("string").alias("_item"))
    pairs = found.select(*_KEY, F.explode("phrases._window").alias("_window")).distinct()
    items = join_counted(pairs, ids, ["_window"]).groupBy(*_KEY).agg(F.sort_array(F.collect_set("_item")).alias("items"))
    covered = F.array_distinct(F.flatten(F.transform("phrases", lambda p: F.sequence(p["start"], p["start"] + p["n"] - 1))))
    hits = found.select(*_KEY, F.size(covered).alias("n_hit"), F.size(F.array_distinct("near._window")).alias("n_near"))
    every = _keyed(docs).select(*_KEY, F.regexp_count("text", F.lit(RAW_WORD)).cast("long").alias("n_words"))
    all_of = join_null_safe(join_null_safe(every, hits, _KEY, "left"), items, _KEY, "left")
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_or_none = F.coalesce("items", none)
    return all_of.select(
        "doc_id", "_text", "n_words", n_hit.alias("n_hit"), F.size(items_or_none).cast("long").alias("n_items"),
        items_or_none.alias("items"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (n_hit > 0).alias("contaminated"))


def digest(report: DataFrame) -> DataFrame:
    return report.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The rows without a phrase match, with the input's columns."""
    found, _ = matches(docs, benchmark, width)
    bad = stage(found.where(F.size("phrases") > 0).select(*_KEY))
    count = bad.count()
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.xxhash64(text_of()).alias("_text"))
    hit = bad.withColumn("_hit", F.lit(True))
    kept = join_null_safe(keyed, F.broadcast(hit) if count <= 1_000_000 else hit, _KEY, "left").where(F.col("_hit").isNull())
    return kept.select("_row.*")
