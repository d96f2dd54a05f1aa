"""Personal data in texts: expressions propose, checksums confirm, nearby words weigh.

Base kinds (email, ip, card, phone) are reported whenever their form holds.  The method adds
account numbers (two letters, two check digits, confirmed by mod 97), national numbers and
phone numbers without a country code; their score starts from the form, rises with the
checksum and with a word of the kind's context within ``window`` characters before, and they
are reported from ``threshold`` on, where no base span overlaps.

DataFrame functions only, one pass over the rows and no shuffle.  The patterns try a run of
characters once, from its start or from the end of the match before, so a very long run costs
linear time.  Defined cases: a null text is empty; an empty text has no spans; repeated rows are
reported each; positions count code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.spans import joined, labelled, with_spans

# The forms of the base kinds, in the order in which they are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# The added kinds, their first score and the words that speak for them.
ADDED_KINDS = ("iban", "national", "local")
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_NATIONAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_LOCAL = r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
_FIRST = {"iban": 0.2, "national": 0.3, "local": 0.3}
_WORDS = {
    "iban": r"(?i)\b(iban|account|bank|transfer|konto|compte|cuenta)\b",
    "national": r"(?i)\b(ssn|social|security|national|insurance)\b",
    "local": r"(?i)\b(phone|tel|telephone|mobile|call|fax|telefon|téléphone|teléfono)\b",
}


def mod97(value: Column) -> Column:
    """True if the letters and digits of an account number leave 1 modulo 97."""
    compact = F.regexp_replace(value, " ", "")
    moved = F.regexp_extract_all(F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4)), F.lit("."), F.lit(0))
    rest = F.aggregate(moved, F.lit(0), lambda a, c: F.when(
        F.ascii(c) < 58, (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int"))
    return rest == 1


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _byte(part: Column) -> Column:
    """At most 255, leading zeros or not."""
    return F.coalesce(F.regexp_replace(part, "^0+(?=.)", "").try_cast("int") <= 255, F.lit(False))


def _card(x: Column) -> Column:
    number = _digits(x["v"])
    return F.length(number).between(14, 19) & F.call_function("luhn_check", number)


def personal_data(docs: DataFrame, window: int = 40, threshold: float = 0.5) -> DataFrame:
    """``doc_id, base, spans``: arrays of (s, o, e, kind, score), sorted; ``spans`` holds the base too."""
    text = F.col("text")
    digit = text.rlike("[0-9]")
    found = with_spans(documents(docs), {
        "email": (_EMAIL, F.contains("text", F.lit("@"))),
        "ip": (_IP, digit), "card": (_CARD, digit), "phone": (_PHONE, F.contains("text", F.lit("+"))),
        "iban": (_IBAN, digit), "national": (_NATIONAL, digit), "local": (_LOCAL, digit),
    })
    valid = {
        "email": lambda x: F.lit(True),
        "ip": lambda x: F.forall(F.split(x["v"], r"\."), _byte),
        "card": _card,
        "phone": lambda x: F.length(_digits(x["v"])).between(10, 15),
    }

    def score(kind: str, confirmed: Column) -> object:
        def of(x: Column) -> Column:
            begin = F.greatest(x["s"] - window, F.lit(0))
            near = F.substring(text, begin + 1, x["s"] - begin)
            return F.lit(_FIRST[kind]) + F.when(confirmed(x), 0.4).otherwise(0.0) + F.when(near.rlike(_WORDS[kind]), 0.3).otherwise(0.0)
        return of

    # an account number that fails its checksum is none, whatever stands beside it
    proposed = {"iban": lambda x: mod97(x["v"])}
    confirmed = {"iban": lambda x: F.lit(True), "national": lambda x: F.lit(False), "local": lambda x: F.lit(False)}
    base = F.concat(*[labelled(F.filter(k, valid[k]), k, i, 1.0) for i, k in enumerate(BASE_KINDS)])
    added = F.concat(*[labelled(F.filter(k, proposed[k]) if k in proposed else F.col(k), k, len(BASE_KINDS) + i, score(k, confirmed[k])) for i, k in enumerate(ADDED_KINDS)])
    both = found.select("doc_id", F.array_sort(base).alias("base"), F.filter(added, lambda x: x["score"] >= threshold).alias("more"))
    apart = F.filter("more", lambda a: ~F.exists("base", lambda b: (a["s"] < b["e"]) & (b["s"] < a["e"])))
    return both.select("doc_id", "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
