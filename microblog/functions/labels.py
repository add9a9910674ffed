"""Label, key and score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw corpus labels {0 negative, 2 neutral, 4 positive} map to
# class indices {0, 1, 2}; anything else is missing.
LABEL_MAP = {0: 0, 2: 1, 4: 2}

# Document keys are the 19-digit id followed by this suffix and
# must be 24 hexadecimal characters.
DOC_KEY_SUFFIX = "12345"
DOC_KEY_PATTERN = "^[0-9a-fA-F]{24}$"

# Fixed value: prediction reported for an input that cannot be scored.
BAD_INPUT = -1


def label_remap(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for raw, cls in LABEL_MAP.items():
        out = F.when(c == raw, F.lit(cls)) if out is None else out.when(c == raw, F.lit(cls))
    return out.cast("int")


def document_key(id_str: Column | str) -> Column:
    c = F.col(id_str) if isinstance(id_str, str) else id_str
    return F.concat(c, F.lit(DOC_KEY_SUFFIX))


def valid_document_key(key: Column | str) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(c.rlike(DOC_KEY_PATTERN), F.lit(False))


def argmax(scores: Column | str) -> Column:
    """0-based index of the first maximum of an array of scores."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def log_softmax_at(scores: Column | str, label: Column | str) -> Column:
    """``log(softmax(scores)[label])`` computed stably (max subtracted)."""
    s = F.col(scores) if isinstance(scores, str) else scores
    y = F.col(label) if isinstance(label, str) else label
    m = F.array_max(s)
    lse = m + F.log(F.aggregate(F.transform(s, lambda x: F.exp(x - m)), F.lit(0.0), lambda a, b: a + b))
    return F.element_at(s, y + 1) - lse


def cross_entropy(scores: Column | str, label: Column | str) -> Column:
    return -log_softmax_at(scores, label)
