"""Text expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every Unicode space plus the ASCII control separators, written so that Java and RE2 agree.
SPACE = r"[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]"
WORD = r"[\p{L}\p{N}_]{2,}"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def clean_handles(text: Column) -> Column:
    """Drop @handles, then trim and collapse white space."""
    return F.regexp_replace(strip(F.regexp_replace(text, r"@[\p{L}\p{N}_]+", "")), f"{SPACE}+", " ")


def split_words(text: Column) -> Column:
    """Lower-cased words between white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), f"{SPACE}+"), lambda w: w != "")


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def bigrams(tokens: Column) -> Column:
    """Two-word n-grams by zipping the array with its own tail: linear in the text length."""
    size = F.size(tokens)
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), size - 1),
        F.slice(tokens, F.lit(2), size - 1),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.when(size >= 2, pairs).otherwise(F.array().cast("array<string>"))


def contains_any(text: Column, words: list[str]) -> Column:
    """Substring test against any of the words."""
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def title_label(label: Column) -> Column:
    """An identifier as a heading: underscores become spaces, words are capitalised."""
    return F.initcap(F.replace(label, F.lit("_"), F.lit(" ")))
