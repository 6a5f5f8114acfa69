"""Small building blocks for array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Catalyst merges neighbouring projections, so an expression that is used inside a
    higher-order function would be evaluated again for every array element. A lambda
    variable is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bounds_from_ends(ends: Column) -> Column:
    """Rising exclusive end positions -> array of struct(start, len), 0-based."""

    def spans(stops: Column) -> Column:
        def one(stop: Column, i: Column) -> Column:
            start = F.coalesce(F.get(stops, i - 1), F.lit(0))
            return F.struct(start.alias("start"), (stop - start).alias("len"))

        return F.transform(stops, one)

    return let(ends, spans)


def cut(values: Column, bounds: Callable[[Column], Column]) -> Column:
    """Slices of ``values`` at the struct(start, len) bounds computed from it."""
    return let(
        values,
        lambda v: F.transform(bounds(v), lambda b: F.slice(v, b["start"] + 1, b["len"])),
    )


def positions_where(values: Column, test: Callable[[Column], Column]) -> Column:
    """0-based positions of the elements that satisfy ``test``."""
    marked = F.transform(values, lambda x, i: F.when(test(x), i))
    return F.filter(marked, lambda p: p.isNotNull())


FOLD_BLOCK = 512


def fold_gathering(items: Column, state: Column, step: Callable[[Column, Column], Column], kind: str, gathered: str) -> Column:
    """Fold ``items`` over a struct state while gathering an array: struct(state, gathered).

    ``kind`` and ``gathered`` are the types of the state and of the gathered array. ``step`` takes the state and an item
    and returns struct(state, new), where ``new`` holds what is to be gathered. A fold copies its
    whole accumulator at every step, so the items are folded in blocks: inside one only its
    own gatherings are copied, and all of them only once per block.
    """
    inner_kind = f"struct<state:{kind},gathered:{gathered}>"
    outer_kind = f"struct<state:{kind},gathered:array<{gathered}>>"

    def pair(value: Column, more: Column) -> Column:
        return F.struct(value.alias("state"), more.alias("gathered"))

    def inner(acc: Column, item: Column) -> Column:
        return let(step(acc["state"], item), lambda s: pair(s["state"], F.concat(acc["gathered"], s["new"])))

    def outer(acc: Column, block: Column) -> Column:
        folded = F.aggregate(block, pair(acc["state"], F.array()).cast(inner_kind), inner)
        return let(folded, lambda f: pair(f["state"], F.concat(acc["gathered"], F.array(f["gathered"]))))

    def in_blocks(all_: Column) -> Column:
        number = F.ceil(F.size(all_) / F.lit(FOLD_BLOCK)).cast("int")
        return F.transform(
            F.when(number > 0, F.sequence(F.lit(0), number - 1)).otherwise(F.array().cast("array<int>")),
            lambda b: F.slice(all_, b * FOLD_BLOCK + 1, F.lit(FOLD_BLOCK)))

    start = pair(state, F.array()).cast(outer_kind)
    return F.aggregate(let(items, in_blocks), start, outer, lambda acc: pair(acc["state"], F.flatten(acc["gathered"])))
