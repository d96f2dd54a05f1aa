"""Quality rules: word and line statistics of a text, and lines that a host repeats.

Cross-document line frequency: every normalised line becomes a hash, the distinct texts that hold
it are counted per host, lines in more than ``line_texts`` of them go, and a document of which too
little is left is rejected.  The limit is a number of texts, the same in hosts of every size.
Numbers in a line with a letter count as one number, so "Page 3 of 20" and "Page 4 of 20" are one
line; lines without a letter keep theirs.  DataFrame functions only.

A line counts only through texts that have content of their own.  Copies of one document share
*all* their lines; without this, a large group of copies would look like boilerplate and lose its
last copy here, while choosing one of them is the work of near-duplicate removal.  Own content is
counted by lines, and in texts that are mostly frequent lines by word pairs: there an edited line
of a copy is no content of its own, but a page of much boilerplate and a little text has some.  Below
``own_words`` of it two texts are near duplicates (a ninth: they share 0.8 of their words).

Defined cases: a null text is empty; a null host is a host of its own; an empty text fails the
word limit; repeated rows each get the same verdict, and equal texts of a host count once; an
empty table gives an empty result.  Lines and texts of any length are handled whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, SPACE, WORD, documents, join_counted, join_null_safe, stage, text_of, word_count

# The characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

# White space, other than single blanks and line ends, that a line's normal form has not.
_UNEVEN = ("  ", "\t", "\x0b", "\x0c", "\r")

_NUMBER = r"(?<![0-9A-Za-z_])[0-9]+(?![0-9A-Za-z_])"


@dataclass(frozen=True)
class Limits:
    """Production limits; a line goes if more than ``line_texts`` distinct texts of its host hold it."""

    min_words: int = 50
    repeat_percent: int = 50
    line_texts: int = 20
    #: a text counts for its lines if at least this share of its words is in unfrequented lines
    own_share: float = 0.5
    #: or if at least this share of its words, in unfrequented lines, starts a word pair that few of these texts hold
    own_words: float = 1 / 9
    #: rejected if less than this share of the words is left
    left_share: float = 0.3


def with_statistics(df: DataFrame) -> DataFrame:
    """Adds ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` of ``text``.

    Three-word windows are hashed and sorted inside the row, only in texts that repeat one, so
    a text of n words takes n log n steps and no shuffle.
    """
    kept = list(df.columns)
    words = df.withColumn("_w", F.array_remove(F.split("text", f"[{SPACE}]+", -1), ""))
    words = words.withColumn("_lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)))
    hashed = words.select(
        *kept,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "_w",
    )
    last = F.greatest(F.size("_w") - 2, F.lit(0))
    windows = hashed.withColumn(
        "_t",
        F.zip_with(
            F.zip_with(F.slice("_w", F.lit(1), last), F.slice("_w", F.lit(2), last), lambda a, b: F.xxhash64(a, b)),
            F.slice("_w", F.lit(3), last),
            lambda ab, c: F.xxhash64(ab, c),
        ),
    )
    placed = windows.withColumn(
        "_s",
        F.when(
            F.size(F.array_distinct("_t")) < F.size("_t"),
            F.sort_array(F.zip_with("_t", F.sequence(F.lit(0), F.size("_t") - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    pairs = F.zip_with(
        F.slice("_s", F.lit(1), F.size("_s") - 1),
        F.slice("_s", F.lit(2), F.size("_s") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    starts = F.flatten(F.filter(pairs, lambda x: x.isNotNull()))
    covered = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))
    return placed.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("_s").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
    )


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))


def _normal_lines(text: Column) -> Column:
    """The lines in lower case, other white space and runs of blanks as one blank, numbers beside letters as 0."""
    plain = F.lower(text)
    uneven = reduce(or_, [F.contains(text, F.lit(x)) for x in _UNEVEN])
    plain = F.when(uneven, F.regexp_replace(plain, r"\x20{2,}|[\x09\x0B-\x0D]+", " ")).otherwise(plain)
    return F.transform(F.split(plain, "\n", -1), _folded)


def _folded(line: Column) -> Column:
    return F.when(line.rlike("[0-9]") & line.rlike(r"\p{L}"), F.regexp_replace(line, _NUMBER, "0")).otherwise(line)


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _lines(docs: DataFrame, host: str, texts: bool = False) -> DataFrame:
    """One row per document and line: document key, host, line (both hashed), with ``texts`` the line's words."""
    lines = _normal_lines(F.col("text"))
    found = F.transform(lines, lambda x: F.struct(_line_hash(x).alias("h"), x.alias("x"))) if texts else F.array_distinct(F.transform(lines, _line_hash))
    # outer: else the array is computed once more for an inferred filter; the text itself must not ride through explode, which copies its row for every line
    arrays = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.xxhash64(host).alias("_host"), found.alias("_ls"))
    rows = arrays.select("doc_id", "_text", "_host", F.posexplode_outer("_ls").alias("_at", "_l"))
    h = F.col("_l.h") if texts else F.col("_l")
    more = ["_at", F.col("_l.x").alias("_x")] if texts else []
    return rows.where(h != _line_hash(F.lit(""))).select("doc_id", "_text", "_host", F.xxhash64("_host", h).alias("_line"), *more)


def frequent_lines(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """``doc_id, _text, removed array<long>, removed_words``: the lines to remove, by document.

    Documents without such a line have no row.  ``_text`` is the hash of the text, so rows that
    share an id but not a text stay apart.
    """
    docs = documents(docs, host)
    counts = _lines(docs, host).groupBy("_line").agg(F.count_distinct("_text").alias("_c"))
    often = stage(counts.where(F.col("_c") > limits.line_texts).select("_line"))
    matched = join_counted(_lines(docs, host, texts=True), often, ["_line"])
    # a line that a text repeats counts every time; equal rows of the table count once
    once = matched.groupBy("doc_id", "_text", "_line", "_at").agg(F.first(word_count(F.col("_x"))).alias("_n"))
    found = stage(once.groupBy("doc_id", "_text", "_line").agg(F.sum("_n").alias("_n")))
    words = word_count(F.col("text"))
    texts = documents(docs).select("doc_id", F.xxhash64("text").alias("_text"), words.alias("_words"))
    sizes = texts.groupBy("doc_id", "_text").agg(F.first("_words").alias("_words"), F.count(F.lit(1)).alias("_rows"))
    in_often = found.groupBy("doc_id", "_text").agg(F.sum("_n").alias("_often"))
    rated = stage(join_null_safe(in_often, sizes, ["doc_id", "_text"]))
    by_lines = F.col("_often") <= (1 - limits.own_share) * F.col("_words")
    own = rated.where(by_lines).select("doc_id", "_text").unionByName(_own_by_words(docs, host, rated.where(~by_lines), often, limits))
    held = join_null_safe(found, own, ["doc_id", "_text"]).groupBy("_line").agg(F.count_distinct("_text").alias("_c"))
    gone = stage(held.where(F.col("_c") > limits.line_texts).select("_line"))
    return (
        join_counted(found, gone, ["_line"]).groupBy("doc_id", "_text")
        .agg(F.collect_set("_line").alias("removed"), F.sum("_n").alias("removed_words"))
    )


def _own_by_words(docs: DataFrame, host: str, mostly: DataFrame, often: DataFrame, limits: Limits) -> DataFrame:
    """``doc_id, _text`` of the texts of ``mostly`` frequent lines that have words of their own beside them.

    A word pair is not a text's own if more of these texts than the limit hold it, in any line.
    Only the texts of ``mostly`` are cut into lines.
    """
    key = ["doc_id", "_text"]
    mostly = stage(mostly.select(*key, "_words", "_rows"))
    small = mostly.count() <= BROADCAST_ROWS
    keys = mostly.select(*key)
    wanted = join_null_safe(docs.withColumn("_text", F.xxhash64("text")), F.broadcast(keys) if small else keys, key, "left_semi")
    marked = join_counted(_lines(wanted, host, texts=True), often.withColumn("_frequent", F.lit(True)), ["_line"], "left")
    words = F.array_remove(F.split(F.trim("_x"), f"[{SPACE}]+", -1), "")
    # the last word of a line pairs with the line's end
    pairs = F.transform(words, lambda w, i: F.xxhash64("_host", w, F.coalesce(F.get(words, i + 1), F.lit("\n"))))
    each = stage(marked.select(*key, F.coalesce("_frequent", F.lit(False)).alias("_frequent"), F.explode(pairs).alias("_pair")))
    common = stage(each.groupBy("_pair").agg(F.count_distinct("_text").alias("_c")).where(F.col("_c") > limits.line_texts).select("_pair"))
    rest = join_counted(each.where(~F.col("_frequent")), common, ["_pair"], "left_anti")
    counted = join_null_safe(rest.groupBy(*key).agg(F.count(F.lit(1)).alias("_own")), mostly, key)
    # rows that repeat in the table are all in the count
    return counted.where(F.col("_own") >= limits.own_words * F.col("_words") * F.col("_rows")).select(*key)


def _verdicts(docs: DataFrame, removed: DataFrame, limits: Limits) -> DataFrame:
    stats = with_statistics(documents(docs)).select("*", F.xxhash64("text").alias("_text")).drop("text")
    joined = join_null_safe(stats, removed.select("doc_id", "_text", "removed_words"), ["doc_id", "_text"], "left")
    gone = F.coalesce("removed_words", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed(limits).alias("base_failed"), gone.alias("removed_words"),
        (~base_failed(limits) & (F.col("n_words") - gone >= limits.left_share * F.col("n_words"))).alias("kept"),
    )


def quality_verdicts(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per row: ``doc_id``, the statistics, ``base_failed``, ``removed_words``, ``kept``."""
    return _verdicts(docs, frequent_lines(docs, host, limits), limits).drop("_text")


def apply_quality(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, their host's repeated lines removed, with the input's columns.

    ``n_chars``, if there is one, follows the text.  Verdicts are staged before they are filtered:
    a filter on them would be pushed below the statistics and compute those once more.
    """
    key = ["doc_id", "_text"]
    removed = stage(frequent_lines(docs, host, limits))
    passed = stage(_verdicts(docs, removed, limits).select(*key, "kept")).where("kept").select(*key).distinct()
    lines = stage(join_null_safe(passed, removed.select(*key, "removed"), key, "left"))
    keyed = docs.select(
        F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"), "doc_id", text_of().alias("_t0"),
        F.xxhash64(text_of()).alias("_text"), F.xxhash64(host).alias("_host"))
    small = lines.count() <= BROADCAST_ROWS
    left = join_null_safe(keyed, F.broadcast(lines) if small else lines, key)
    hashed = F.zip_with(F.split("_t0", "\n", -1), _normal_lines(F.col("_t0")), lambda x, y: F.struct(x.alias("x"), F.xxhash64("_host", _line_hash(y)).alias("h")))
    kept_lines = F.filter(hashed, lambda x: ~F.array_contains("removed", x["h"]))
    text = F.when(F.col("removed").isNull(), F.col("_t0")).otherwise(F.array_join(F.transform(kept_lines, lambda x: x["x"]), "\n"))
    out = left.select("_row", text.alias("_new"))
    columns = []
    for f in docs.schema.fields:
        if f.name == "text":
            columns.append(F.col("_new").alias("text"))
        elif f.name == "n_chars":
            columns.append(F.length("_new").cast(f.dataType).alias("n_chars"))
        else:
            columns.append(F.col("_row")[f.name].alias(f.name))
    return out.select(*columns)
