"""Word splitting that matches Python's ``str.split()`` with no argument.

Java's ``\\s`` misses several characters Python treats as whitespace (no-break
space, the Unicode spaces, the file/group/record/unit separators). The class
below names every one of them so that a word array built on executors equals
the one a Python loop would build.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, as a regex class
# understood by both Java regex and RE2.
WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)


# The same characters for Spark alone: one look at a character's kind, where the class above is asked range by range.
SPARK_WHITESPACE = r"(?U)[\s\x{1C}-\x{1F}]+"


def words(text: Column) -> Column:
    """``array<string>`` of the words of ``text``; empty or blank text gives ``[]``."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPARK_WHITESPACE), "")


def head_words(text: Column, n: int) -> Column:
    """The first ``n`` words joined by single spaces."""
    return F.array_join(F.slice(words(text), 1, n), " ")


def word_count(text: Column) -> Column:
    return F.size(words(text))


# Everything in ASCII but digits and small letters parts terms; other characters belong to them.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """``array<string>`` of the runs of letters and digits in ``text``, A-Z lower-cased; null gives ``[]``."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(folded, F.lit(TERM_PATTERN), F.lit(0))
