"""Text functions as column expressions: stripping, folding, sentences, tokens, names, claim ids."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words that names lose
NAME_STOPWORDS = ("the", "a", "an", "of", "for", "in", "on", "at", "to", "by")
_SPACE = r"(?U)^\s++|(?<!\s)\s++\z"  # a run inside the text is tried once, not from each of its characters


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, _SPACE, "")


@functools.cache
def _accents() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters whose compatibility form is one character without its marks, what they become, and longer forms."""
    one, to, longer = [], [], []
    for code in range(0x80, 0x10000):
        c = chr(code)
        if 0xAC00 <= code < 0xD7A4 or unicodedata.category(c) in ("Cs", "Mn", "Mc"):
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != c and len(plain) == 1:
            one.append(c)
            to.append(plain)
        elif plain != c and code in (*range(0x132, 0x14A), *range(0x1C4, 0x1F4), *range(0xBC, 0xBF), *range(0xFB00, 0xFB07)):
            longer.append((c, plain))
    return "".join(one), "".join(to), tuple(longer)


def fold_accents(text: Column) -> Column:
    """Compatibility forms without combining marks, for the basic plane; stays in the JVM. ASCII texts are left alone."""
    one, to, longer = _accents()
    plain = F.translate(text, one, to)
    letters = "".join(c for c, _ in longer)
    widened = plain
    for c, form in longer:
        widened = F.replace(widened, F.lit(c), F.lit(form))
    folded = F.when(plain.rlike(f"[{letters}]"), widened).otherwise(plain)
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(folded, r"\p{Mn}+", "")).otherwise(text)


def sentences(text: Column) -> Column:
    """Pieces between sentence ends and blank lines, stripped, none empty; null gives none."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n", "\n"), "\n{2,}", "\n\n")
    parts = F.flatten(F.transform(F.split(text, r"(?U)(?<=[.!?])\s+"), lambda s: F.split(s, "\n\n")))
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def tokens(text: Column) -> Column:
    """Lower-cased, unaccented tokens of two or more characters: a word character, then those and . / -"""
    folded = fold_accents(F.lower(F.coalesce(text, F.lit(""))))
    return F.regexp_extract_all(folded, F.lit(r"(?U)\b\w[\w./-]+\b"), F.lit(0))


def with_bigrams(words: Column) -> Column:
    """The words, then each two neighbours with a space between. Pass a column, not an expression: it is read thrice."""
    after = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), after, lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, pairs)


def normalized_name(name: Column) -> Column:
    """A name's key for comparison: plain ASCII, lower case, no quotes, one space for separators, no stop words."""
    plain = F.regexp_replace(fold_accents(name), r"[^\x00-\x7F]", "")
    plain = F.regexp_replace(F.trim(F.lower(plain)), "^[`'\"]+|[`'\"]+\\z", "")
    words = F.split(F.trim(F.regexp_replace(plain, r"[\s\-_/\\.]+", " ")), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*NAME_STOPWORDS) & (w != "")), " ")


def claim_id(subject: Column, relation: Column, obj: Column) -> Column:
    joined = F.concat_ws("|", F.lower(subject), F.lower(relation), F.lower(obj))
    return F.substring(F.sha2(joined, 256), 1, 16)


def statement(subject: Column, relation: Column, obj: Column) -> Column:
    return F.concat(subject, F.lit(" --"), relation, F.lit("--> "), obj)
