"""Helpers on array columns. All of them stay inside the row: no shuffle."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, wraps

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def built_once(build: Callable) -> Callable:
    """Keep the expressions a builder returns for each set of arguments.

    A page extractor takes thousands of small calls to the JVM to put together.
    Expressions name their columns and hold no data, so an application can use
    the same one in every query and micro-batch.
    """

    @cache
    def keep(_application: str, *args):
        return build(*args)

    @wraps(build)
    def get(*args):
        return keep(SparkSession.active().sparkContext.applicationId, *args)

    return get


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A fold over no items, whose start is the value: unlike an array of one item that is mapped and read, it copies no results and
    doesn't derive their type again for every row.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def span(items: Column, first: Column, last: Column) -> Column:
    """Items ``first..last`` (from 0, both included) of an array.

    ``slice`` copies the whole array when it runs inside a lambda; this reads
    only the asked items.
    """
    return F.transform(
        F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.get(items, i),
    )


def rank(items: Column, place: Column) -> Column:
    """How many items of an array that rises by ``id`` have an id of at most ``place``, by binary search."""
    def steps(bits: int) -> Column:
        return F.array(*[F.lit(1 << k) for k in reversed(range(bits))])

    # an array has fewer than 2^31 items; most have few
    chosen = F.when(F.size(items) < 64, steps(6)).otherwise(steps(30))
    return let(place, lambda at: F.aggregate(
        chosen, F.lit(0),
        lambda found, step: F.when(
            (found + step <= F.size(items)) & (F.get(items, found + step - 1)["id"] <= at), found + step
        ).otherwise(found),
    ))


#: Items that a fold appends to one array: appending copies, so long arrays are folded in pieces.
_PIECE = 512


def outermost(spans: Column) -> Column:
    """Of nested or disjoint spans (id, last) that rise by id those that lie in no other.

    One sweep that keeps the end of the last span taken.
    """
    def sweep(items: Column, until: Column) -> Column:
        start = F.struct(until.alias("until"), F.array().cast("array<struct<id:int,last:int>>").alias("kept"))
        return F.aggregate(items, start, lambda s, x: F.when(
            x["id"] > s["until"], F.struct(x["last"].alias("until"), F.concat(s["kept"], F.array(x)).alias("kept"))
        ).otherwise(s))

    def pieces(items: Column) -> Column:
        start = F.struct(F.lit(-1).alias("until"), F.array().cast("array<array<struct<id:int,last:int>>>").alias("kept"))
        swept = F.aggregate(
            F.sequence(F.lit(0), F.size(items) - 1, F.lit(_PIECE)), start,
            lambda s, first: let(
                sweep(span(items, first, F.least(first + _PIECE, F.size(items)) - 1), s["until"]),
                lambda f: F.struct(f["until"].alias("until"), F.concat(s["kept"], F.array(f["kept"])).alias("kept")),
            ),
        )
        return F.flatten(swept["kept"])

    return let(spans, lambda items: F.when(F.size(items) < 2, items).when(
        F.size(items) <= _PIECE, sweep(items, F.lit(-1))["kept"]
    ).otherwise(pieces(items)))


def within_spans(place: Column, spans: Column) -> Column:
    """Does a position lie in one of the disjoint spans, behind its begin?"""
    return let(rank(spans, place - 1), lambda k: (k > 0) & (F.get(spans, k - 1)["last"] >= place))


def drop_empty(texts: Column) -> Column:
    """Remove NULL and empty strings from an array of texts; NULL becomes empty."""
    return F.coalesce(
        F.filter(texts, lambda t: t.isNotNull() & (t != "")),
        F.array().cast("array<string>"),
    )


def pairs(items: Column) -> Column:
    """Consecutive (first, second) pairs of an array; an odd tail has no second."""
    return let(items, lambda xs: F.transform(
        F.filter(
            F.transform(xs, lambda x, i: F.struct(
                x.alias("first"), F.get(xs, i + 1).alias("second"), i.alias("i")
            )),
            lambda p: p["i"] % 2 == 0,
        ),
        lambda p: F.struct(p["first"].alias("first"), p["second"].alias("second")),
    ))


def fill_headings(items: Column, is_heading: Callable[[Column], Column],
                  heading: Callable[[Column], Column],
                  build: Callable[[Column, Column], Column]) -> Column:
    """Give each item of an ordered array the latest heading at or above it.

    The array is cut at its headings and each piece is mapped with its own
    heading, so the work is linear in the array and stays inside the row. Items
    above the first heading get NULL.
    """
    marks = F.filter(
        F.transform(items, lambda n, i: F.when(is_heading(n), i)), lambda i: i.isNotNull()
    )

    def piece(k: Column, cuts: Column) -> Column:
        begin = F.get(cuts, k)
        end = F.coalesce(F.get(cuts, k + 1), F.size(items))
        title = F.when(k > 0, heading(F.get(items, begin)))
        return let(
            title,
            lambda t: F.transform(
                span(items, begin, end - 1), lambda n: build(n, t)
            ),
        )

    return let(
        F.concat(F.array(F.lit(0)), marks),
        lambda cuts: F.flatten(
            F.transform(F.sequence(F.lit(0), F.size(cuts) - 1), lambda k: piece(k, cuts))
        ),
    )
