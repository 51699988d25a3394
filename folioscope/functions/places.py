"""Places in a text as sorted arrays, in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import let

_CHUNK = 64
#: A character of private use.
_UNUSED = "\ue000"


def _sums(sizes: Column) -> Column:
    return F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))


def running(sizes: Column) -> Column:
    """[0, s1, s1 + s2, ...] without the sum of all.

    Sums are made in chunks and moved by the sums of the chunks before, so a long array is not copied for each of its elements.
    """

    def over(xs: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(xs), F.lit(_CHUNK)), lambda i: i < F.size(xs))
        chunks = F.transform(starts, lambda i: _sums(F.slice(xs, i + 1, _CHUNK)))
        moved = lambda cs: F.zip_with(cs, F.slice(_sums(F.transform(cs, lambda c: F.element_at(c, -1))), 1, F.size(cs)), lambda c, before: F.transform(F.slice(c, 1, F.size(c) - 1), lambda x: x + before))
        return F.when(F.size(xs) <= _CHUNK, F.slice(_sums(xs), 1, F.size(xs))).otherwise(F.flatten(let(chunks, moved)))

    return let(sizes, over)


def _split(text: Column, pattern: str) -> Column:
    """split(), whose pattern would be compiled anew for each text; replacing keeps it, and a single character needs none."""
    return F.when(F.contains(text, F.lit(_UNUSED)), F.split(text, pattern, -1)).otherwise(F.split(F.regexp_replace(text, pattern, _UNUSED), _UNUSED, -1))


def _cut(text: Column, pattern: str, body) -> Column:
    """body(parts, matches, places of the parts) of a pattern of at least one character."""
    both = F.struct(_split(text, pattern).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    sizes = lambda x: F.zip_with(x["parts"], x["found"], lambda p, m: (F.length(p) + F.coalesce(F.length(m), F.lit(0))).cast("long"))
    return let(both, lambda x: body(x["parts"], x["found"], F.when(F.size(x["found"]) == 0, F.array(F.lit(0).cast("long"))).otherwise(running(sizes(x)))))


def parts(text: Column, pattern: str) -> Column:
    """array<struct<at, part>>: the text between matches of a pattern of at least one character, with the place (from 0) of each part's first character."""
    return _cut(text, pattern, lambda between, found, at: F.zip_with(at, between, lambda a, p: F.struct(a.cast("int").alias("at"), p.alias("part"))))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<end, found>>: the matches of a pattern of at least one character, with the place after each."""
    # the part after a match begins where the match ends
    return _cut(text, pattern, lambda between, found, at: F.zip_with(F.slice(at, 2, F.size(found)), found, lambda a, m: F.struct(a.cast("int").alias("end"), m.alias("found"))))


def last_until(sorted_: Column, place: Column) -> Column:
    """The last element of an array of (at, ...), sorted by at and beginning with 0, whose at is not after a place: by halving."""
    half = lambda s: F.shiftright(s["lo"] + s["hi"] + 1, 1)
    step = lambda s, _: let(half(s), lambda m: F.when(F.get(sorted_, m)["at"] <= place, F.struct(m.alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), (m - 1).alias("hi"))))
    start = F.struct(F.lit(0).alias("lo"), (F.size(sorted_) - 1).alias("hi"))
    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(sorted_) + 1.0)).cast("int") + 1)
    found = F.aggregate(rounds, start, lambda s, i: F.when(s["lo"] < s["hi"], step(s, i)).otherwise(s), lambda s: s["lo"])
    return F.get(sorted_, F.when(F.size(sorted_) == 1, 0).otherwise(found))
