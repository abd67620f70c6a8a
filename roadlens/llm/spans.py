"""Places of regular-expression matches, in code points, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start: int, end: int, hit: string, group: string>>"


#: Elements that are added up one after another, and characters of a text's pieces: steps grow with an array's or text's length times these.
RUN, PIECE = 256, 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is computed once however often the body names it, in lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def before_each(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array of numbers what step has made of those before it, from zero on; step has to be associative.

    Runs of RUN elements are added up each for itself, then the runs: an array that grows by one in a fold is copied each time.
    """
    kind = "cast(array() as array<int>)"
    grow = lambda start, xs: F.aggregate(xs, F.struct(start.alias("at"), F.expr(kind).alias("out")), lambda a, x: F.struct(step(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
    runs = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda k: F.slice(v, k * RUN + 1, F.lit(RUN)))
    made = lambda r: let(grow(zero, F.transform(r, lambda xs: F.aggregate(xs, zero, step))), lambda starts: F.flatten(F.transform(r, lambda xs, k: grow(F.get(starts, k), xs))))
    return let(values, lambda v: F.when(F.size(v) == 0, F.expr(kind)).otherwise(let(runs(v), made)))


def pieces_of(text: Column) -> Column:
    """A text in pieces of PIECE characters, for `cut_out`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut_out(pieces: Column, start: Column, end: Column) -> Column:
    """The characters of a text from start to before end, without counting from its beginning."""
    first = F.floor(start / PIECE).cast("int")
    held = F.array_join(F.slice(pieces, first + 1, F.floor((end - 1) / PIECE).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(held, start - first * PIECE + 1, end - start)).otherwise("")


def found(text: Column, pattern: str, group: int = 0, guard: Column | None = None) -> Column:
    """Leftmost non-overlapping matches: start, end (exclusive), the match and one of its groups.

    The pieces between matches and the matches themselves take turns, so their lengths add up to the places. Patterns
    must not match the empty string. guard: a cheap condition without which there can be no match. Time is linear in the
    text's length and the number of matches, but for the sum over every RUN of them.
    """
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.filter(F.arrays_zip(pieces.alias("piece"), hits.alias("hit"), groups.alias("grp")), lambda x: x["hit"].isNotNull())

    def placed(z: Column) -> Column:
        sizes = F.transform(z, lambda x: F.length(x["piece"]) + F.length(x["hit"]))
        return let(before_each(sizes, F.lit(0), lambda a, n: a + n), lambda before: F.transform(z, lambda x, k: spanned(F.get(before, k) + F.length(x["piece"]), x)))

    spanned = lambda begin, x: F.struct(begin.alias("start"), (begin + F.length(x["hit"])).alias("end"), x["hit"].alias("hit"), x["grp"].alias("group"))
    has = F.regexp(text, F.lit(pattern)) if guard is None else guard & F.regexp(text, F.lit(pattern))
    return F.when(has, let(zipped, placed)).otherwise(F.expr(f"cast(array() as {SPAN})"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, of an array of structs that is sorted already."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def tagged(spans: Column, rank: int, kind: str, base: bool, score=lambda s: F.lit(100)) -> Column:
    """Spans as structs that sort by start, then by the rank of their kind. score: of a span, in hundredths."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(base).alias("base"), score(s).cast("int").alias("score")))
