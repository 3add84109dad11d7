"""Regular-expression spans as columns (no Python on the executors).

Work on a text grows about linearly with its length and its matches: positions
come from running sums by doubling steps instead of a fold that copies what it
has so far, and short stretches are read from blocks of the text instead of
from its beginning.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 1024  # code points of a block of a text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often, and in
    whatever inner function, the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running results of an associative ``combine(before, value)``
    over an array: after the step of distance d each place holds the result of
    the 2 * d places that end there."""
    def step(distance, done):
        return F.transform(done, lambda v, i: F.when(i >= distance, combine(F.get(done, i - distance), v)).otherwise(v))

    def steps(a):
        rounds = F.ceil(F.log2(F.size(a).cast("double"))).cast("int")
        distances = F.transform(F.sequence(F.lit(1), rounds), lambda r: F.pow(F.lit(2.0), r - 1).cast("int"))
        return F.when(F.size(a) < 2, a).otherwise(F.aggregate(distances, a, lambda acc, d: step(d, acc)))

    return let(values, steps)


def matches(text: Column, pattern: str, group: int | None = None, needs: tuple[str, ...] = ()) -> Column:
    """``array<struct<start, end, value[, part]>>``: the leftmost matches, one
    after another without overlap, in code points; ``part`` is a group's text.
    The stretches between matches, as a split by the same pattern gives them,
    tell where the matches lie.  ``pattern`` must not match the empty text.
    Any match holds one of the strings ``needs``, which are cheaper to seek."""
    quoted = F.lit(pattern)
    kind = "struct<start: int, end: int, value: string" + (", part: string>" if group else ">")
    parts = [F.regexp_extract_all(text, quoted, F.lit(group)).alias("p")] if group else []

    def placed(found):
        gap = F.transform(F.split(text, pattern, -1), lambda s: F.char_length(s))
        step = F.zip_with(F.slice(gap, F.lit(1), F.size(found)), found, lambda g, v: g + F.char_length(v))
        zipped = F.arrays_zip(running(step, lambda a, b: a + b).alias("e"), found.alias("v"), *parts)

        def span(x):
            fields = [(x["e"] - F.char_length(x["v"])).alias("start"), x["e"].alias("end"), x["v"].alias("value")]
            return F.struct(*fields, *([x["p"].alias("part")] if group else []))

        return F.transform(zipped, span).cast(f"array<{kind}>")

    none = F.array().cast(f"array<{kind}>")
    likely = text.rlike(pattern)
    if needs:
        likely = reduce(lambda a, b: a | b, [text.contains(x) for x in needs]) & likely
    return F.when(likely, let(F.regexp_extract_all(text, quoted, F.lit(0)), placed)).otherwise(none)


def blocks(text: Column) -> Column:
    """The text in blocks of BLOCK code points, for :func:`stretch`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def stretch(parts: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text given as :func:`blocks`; reads the
    blocks that it touches only."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor(F.greatest(end - 1, start) / BLOCK).cast("int")
    block = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
    near = F.when(first == last, block(first)).otherwise(F.concat(block(first), block(last)))
    held = F.when(last - first <= 1, near).otherwise(F.array_join(F.slice(parts, first + 1, F.greatest(last - first + 1, F.lit(0))), ""))
    return F.substring(held, start - first * BLOCK + 1, F.greatest(end - start, F.lit(0)))


def apart(spans: Column, base: Column) -> Column:
    """The spans that touch none of ``base``, by start.  Both are laid in one
    order by start; a span touches a base span if the greatest end of those
    before it reaches into it, or the next one starts before its end."""
    low, high = F.lit(-1), F.lit(2**31 - 1)

    def judged(every):
        ends = running(F.transform(every, lambda x: F.when(x["base"], x["at"]["end"]).otherwise(low)), lambda a, b: F.greatest(a, b))
        starts = F.reverse(running(F.reverse(F.transform(every, lambda x: F.when(x["base"], x["at"]["start"]).otherwise(high))),
                                   lambda a, b: F.least(a, b)))
        zipped = F.arrays_zip(every.alias("x"), ends.alias("e"), starts.alias("s"))
        free = F.filter(zipped, lambda z: ~z["x"]["base"] & (z["e"] <= z["x"]["at"]["start"]) & (z["s"] >= z["x"]["at"]["end"]))
        return F.transform(free, lambda z: z["x"]["at"])

    def tagged(array, flag):
        return F.transform(array, lambda x: F.struct(x["start"].alias("start"), F.lit(flag).alias("base"), x.alias("at")))

    every = F.array_sort(F.concat(tagged(spans, False), tagged(base, True)))
    return F.when((F.size(spans) == 0) | (F.size(base) == 0), F.array_sort(spans)).otherwise(let(every, judged))
