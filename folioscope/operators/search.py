"""Phrase search in documents with a cascade of looser forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import has_all_characters, is_blank, no_space, one_space

#: Zero-width characters that text layers contain.
INVISIBLE = "[​‌‍⁠﻿­]"


def matchable(text: Column) -> Column:
    """Without invisible characters, wide ASCII forms made narrow, white space collapsed."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
    narrow = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
    return one_space(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), INVISIBLE, ""), wide, narrow))


def status(text: Column, other: Column, needle: str, least: int = 50) -> Column:
    """MATCH_EXACT, MATCH_ALT (in the other text), MATCH_COMPACT (without white space), NO_TEXT, SUSPECT_SPLIT or NOT_FOUND."""
    n = F.lit(needle)
    bare = F.lit("".join(needle.split()))
    short = (F.length(no_space(text)) < least) & (F.length(no_space(other)) < least)
    return (
        F.when(F.contains(matchable(text), n), "MATCH_EXACT")
        .when(F.contains(matchable(other), n), "MATCH_ALT")
        .when(F.contains(no_space(matchable(text)), bare) | F.contains(no_space(matchable(other)), bare), "MATCH_COMPACT")
        .when(short | (is_blank(text) & is_blank(other)), "NO_TEXT")
        .when(has_all_characters(F.coalesce(text, F.lit("")), bare), "SUSPECT_SPLIT")
        .otherwise("NOT_FOUND")
    )


def keyword_pairs(docs, text: str, keywords: list[tuple[str, int]]):
    """A row for each document and keyword that it contains: the dictionary is exploded in place, no join is needed."""
    table = F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(w).alias("weight")) for k, w in keywords])
    rest = [c for c in docs.columns if c != text]
    found = F.filter(table, lambda k: F.contains(F.coalesce(F.col(text), F.lit("")), k["keyword"]))
    return docs.select(*rest, F.explode(found).alias("k")).select(*rest, "k.keyword", "k.weight")
