"""Plain restatements of what the text operators compute, row by row."""

import hashlib
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0D]+")

#: texts that every operator on documents has to take
ODD_TEXTS = [
    None, "", " ", "\n\n", "x", "😀 é\x0bÉ\ta\r\nb", "a" * 50_000, "w " * 20_000,
    "same line\nsame line\nother", "same line\nsame line\nother", "\x00 null byte", "1 2 3 4 5",
]


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def documents(spark, texts, first=0):
    """Documents with clashing extra columns: names that the results use."""
    rows = [(i + first if i != 3 else None, t, ["en", "de", None][i % 3], ["s1", None, "s2"][i % 3], len(t or ""), "extra", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words string, label int")


def empty(spark):
    return documents(spark, []).limit(0)
