"""Tokenisers and text cleaners as Spark column expressions.

Two tokenisers exist because the analysed stream and the training corpus were
split differently:

* ``space_tokens``: a Java ``String.split(" ")`` — single-space delimiter,
  interior empty tokens kept, trailing empty tokens removed, newline is not a
  delimiter, an all-space text gives no tokens and the empty text one empty
  token.
* ``ws_tokens``: a Python ``str.split()`` — any run of whitespace, no empty
  tokens.
"""

from __future__ import annotations

import string
import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 32 ASCII punctuation characters deleted by both cleaners
# (Python's ``string.punctuation``), in their natural order.
PUNCT = string.punctuation

# Prefixes that mark a tracked token or a link.
HASHTAG_PREFIX = "#"
MENTION_PREFIX = "@"
LINK_PREFIX = "http"


@lru_cache(maxsize=1)
def whitespace_chars() -> str:
    """Every code point Python's ``str.isspace`` accepts (rule, not a table)."""
    return "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())


def ws_pattern() -> str:
    """Regex for one whitespace run; literal characters inside a class read
    the same in Java regex and RE2, so the oracle SQL can reuse it."""
    return "[" + whitespace_chars() + "]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def space_tokens(text: Column | str) -> Column:
    """``text.split(" ")`` with Java semantics."""
    t = _col(text)
    stripped = F.rtrim(t, F.lit(" "))   # trailing spaces only (newlines stay), no regex
    return F.when((stripped == "") & (t != ""), F.array().cast("array<string>")).otherwise(
        F.split(stripped, " ")
    )


def ws_tokens(text: Column | str) -> Column:
    """``text.split()`` with Python semantics."""
    return F.filter(F.split(_col(text), ws_pattern()), lambda w: w != "")


def prefixed(tokens: Column, prefix: str) -> Column:
    """Tokens that start with ``prefix`` (case-sensitive, punctuation kept)."""
    return F.filter(tokens, lambda w: w.startswith(prefix))


def hashtags(text: Column | str) -> Column:
    return prefixed(space_tokens(text), HASHTAG_PREFIX)


def mentions(text: Column | str) -> Column:
    return prefixed(space_tokens(text), MENTION_PREFIX)


def strip_punct(c: Column) -> Column:
    return F.translate(c, PUNCT, "")


def clean_full(text: Column | str) -> Column:
    """Training-side clean: lower, split on whitespace, drop words that start
    with ``@``/``#``/``http``, join with one space, delete punctuation."""
    words = ws_tokens(F.lower(_col(text)))
    kept = F.filter(
        words,
        lambda w: ~F.substring(w, 1, 1).isin(MENTION_PREFIX, HASHTAG_PREFIX) & ~w.startswith(LINK_PREFIX),
    )
    return strip_punct(F.array_join(kept, " "))


def clean_serving(text: Column | str) -> Column:
    """Serving-side clean: ``str()`` (a missing text becomes ``None``), lower,
    delete punctuation. Mentions, tags and links stay as words."""
    return strip_punct(F.lower(F.coalesce(_col(text), F.lit("None"))))


def is_blank(text: Column | str) -> Column:
    """Python ``isspace()``: non-empty and whitespace only."""
    return _col(text).rlike("^" + ws_pattern() + "\\z")


def term_tokens(text: Column | str) -> Column:
    """Lower-cased whitespace tokens with punctuation (incl. ``#``/``@``) removed."""
    return F.transform(ws_tokens(F.lower(_col(text))), strip_punct)


def has_any_term(text: Column | str, terms: list[str]) -> Column:
    wanted = [t.lower() for t in terms]
    return F.exists(term_tokens(text), lambda w: w.isin(*wanted))
