"""Text rules as Column expressions.

Regular expressions are written with explicit character classes so Java's regex
engine (Spark) and RE2 (the SQL oracle) agree; ``\\s`` differs between them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (semantics the results depend on).
# Python's str.strip() removes Unicode White_Space plus the separators U+001C..U+001F;
# Java's (?U)\s is Unicode White_Space, so this class reproduces str.strip() exactly.
PY_SPACE_CLASS = r"[\s\x1c-\x1f]"
NOT_PY_SPACE = r"(?U)[^\s\x1c-\x1f]"
# A sentence starts at a character that is neither whitespace nor a terminator and runs
# through the next run of terminators (or to the end of the text).
SENTENCE_PATTERN = r"[^ \t\n\r.!?][^.!?]*[.!?]*"
ASCII_SPACE_RUN = r"[ \t\n\r]+"
# A term is a maximal run of Unicode letters or digits.
TERM_PATTERN = r"[\p{L}\p{N}]+"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True when Python's ``not text.strip()`` would be true (null counts as blank)."""
    c = col_(c)
    return F.coalesce(~c.rlike(NOT_PY_SPACE), F.lit(True))


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()`` with no arguments."""
    return F.regexp_replace(col_(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def truthy_text(*cols: Column | str) -> Column:
    """First non-null, non-empty string, else '' (Python ``a or b or ''``)."""
    return F.coalesce(*[F.nullif(col_(c), F.lit("")) for c in cols], F.lit(""))


def sentences(c: Column | str) -> Column:
    """array<string> of sentences, inner whitespace runs folded to one space."""
    raw = F.regexp_extract_all(col_(c), F.lit(SENTENCE_PATTERN), 0)
    return F.transform(raw, lambda s: F.trim(F.regexp_replace(s, ASCII_SPACE_RUN, " ")))


def lead_sentences(c: Column | str, n: int) -> Column:
    """The first ``n`` sentences joined by one space ('' when there is none)."""
    return F.array_join(F.slice(sentences(c), 1, n), " ")


def word_tokens(c: Column | str) -> Column:
    """Whitespace tokens (no empty tokens; '' gives an empty array)."""
    return F.filter(F.split(col_(c), ASCII_SPACE_RUN), lambda t: t != "")


def terms(c: Column | str) -> Column:
    """Lower-cased letter/digit runs."""
    return F.regexp_extract_all(F.lower(col_(c)), F.lit(TERM_PATTERN), 0)
