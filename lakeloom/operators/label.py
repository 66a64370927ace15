"""Closed-set labels from free-form answers, and text heads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import head_words

# The label set, in the order it is tried; the fallback label.
LABELS = ["positive", "negative", "neutral"]
FALLBACK = "neutral"
HEAD_WORDS = 220


def label_from_answer(answer: Column, labels=LABELS, fallback: str = FALLBACK) -> Column:
    """The first label (in list order) contained in the lower-cased answer, else ``fallback``."""
    low = F.lower(F.coalesce(answer, F.lit("")))
    expr = F.lit(fallback)
    for label in reversed(labels):
        expr = F.when(low.contains(label), F.lit(label)).otherwise(expr)
    return expr


def text_head(text: Column, n: int = HEAD_WORDS) -> Column:
    return head_words(text, n)
