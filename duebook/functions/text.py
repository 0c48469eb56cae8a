"""Text expressions: word splitting, word-window chunks, page text and rendered documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate words. Unicode white space as the predefined class of the regular
# expression engine (several times faster than listing it) and the four separator controls.
WORD_BREAK = r"(?U)[\s\x1c-\x1f]+"
# The same characters listed, for engines without that class.
WHITE_SPACE = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# What is taken out of a page, in order.
PAGE_RULES: tuple[tuple[str, str], ...] = (
    (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?s)<[^>]+>", " "),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"\n{3,}", "\n\n"),
    (r" {2,}", " "),
)


def words(text: Column) -> Column:
    """The words of the whole text, in order; an empty array for NULL or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK, -1), "")


def word_windows(tokens: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` words, each starting ``size - overlap`` after the last; none for no words."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the window size")
    starts = F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1, F.lit(size - overlap))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda s: F.array_join(F.slice(tokens, s + 1, F.lit(size)), " "))


def page_text(html: Column) -> Column:
    """Readable text of a page; empty for NULL."""
    text = F.coalesce(html, F.lit(""))
    for pattern, replacement in PAGE_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(text)


def missing_count(text: Column, required: Sequence[str]) -> Column:
    """How many of the required substrings do not occur."""
    total = F.lit(0)
    for part in required:
        total = total + (~F.contains(F.coalesce(text, F.lit("")), F.lit(part))).cast("int")
    return total
