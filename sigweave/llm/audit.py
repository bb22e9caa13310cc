"""How filters interact: what each removes in every order in which they could run.

A text fails some of the filters, which is its mask. Documents are counted once by part, mask
and labels; a part has at most 2 ** filters such cells whatever its size. Each cell is folded
over the array of all orders (a literal of the plan) with ``transform`` and ``aggregate`` into
one struct of weighted counts for each order and step, and the cells of a part are merged by
adding the structs place by place. Nothing is exploded before it is merged.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that a text decides by itself; a null text is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(text).cast("long"),
        "D": text.rlike(SYMBOLS),
    }


def _mask(fails: Sequence[Column]) -> Column:
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)]
    mask = F.lit(0)
    for bit in bits:
        mask = mask + bit
    return mask


def cells(
    docs: DataFrame, labels: DataFrame, part: str = "source", copies: str | None = "E"
) -> tuple[DataFrame, list[str]]:
    """Documents counted by part and mask, and the filters' names in order of their bits.

    Columns: part, mask, n, good, toxic. The filters are those of ``text_filters`` and, named
    ``copies``, that a text is also the text of a smaller doc_id anywhere in ``docs``; rows
    that repeat a doc_id and text are no copies of each other, and a null doc_id is neither
    smaller nor larger than any. Labels count if one row of their doc_id has a 1.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = text_filters(F.col("text"))
    names = [*found, *([copies] if copies else [])]
    # One row per document and text, counted before the shuffle; texts go no further.
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            _mask(list(found.values())).alias("mask"),
        )
        .groupBy("doc_id", "part", "digest", "mask")
        .agg(F.count("*").alias("n"))
    )
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    marked = rows.join(marks, "doc_id", "left").fillna({"good": False, "toxic": False})
    if copies:
        marked = _with_copies(marked, 1 << (len(names) - 1))
    counted = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    return counted, names


def _with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """``rows`` (part, digest, mask, good, toxic, n) with ``bit`` set for later copies.

    Rows of a text are merged by part and labels, which leaves a few whatever the number of
    copies: how many there are, the smallest doc_id, and how many rows have it.
    """
    group = ["digest", "part", "mask", "good", "toxic"]
    lead = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    merged = rows.groupBy(group).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(lead).alias("lead"),
    )
    least = merged.groupBy("digest").agg(F.min("lead.doc_id").alias("least"))
    joined = merged.join(least, "digest")
    here = F.coalesce(F.col("lead.doc_id") == F.col("least"), F.lit(False))
    first = F.col("unnamed") + F.when(here, F.col("lead.n")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), first.alias("n")),
        F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - first).alias("n")),
    )
    return (
        joined.select("part", "good", "toxic", F.explode(both).alias("cell"))
        .select("part", "good", "toxic", "cell.*")
        .filter("n > 0")
    )


def _orders(names: Sequence[str]) -> tuple[Column, list[str]]:
    """All orders as an array of arrays of bits, and their names."""
    found = list(itertools.permutations(range(len(names))))
    bits = F.array(*[F.array(*[F.lit(1 << f) for f in order]) for order in found])
    return bits, ["".join(names[f] for f in order) for order in found]


def _folded(cell: Column, orders: Column) -> Column:
    """One struct for each order and step of a cell, in a row."""
    zero = F.lit(0).cast("long")
    nothing = F.array().cast(f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>")

    def along(order: Column) -> Column:
        def step(state: Column, bit: Column) -> Column:
            alive = state["alive"]
            fails = cell["mask"].bitwiseAND(bit) != 0
            removed = alive & fails
            counts = F.struct(
                F.when(alive & ~fails, cell["n"]).otherwise(zero).alias("kept"),
                F.when(removed, cell["n"]).otherwise(zero).alias("removed"),
                F.when(~alive & fails, cell["n"]).otherwise(zero).alias("redundant"),
                F.when(cell["mask"] == bit, cell["n"]).otherwise(zero).alias("unique_fails"),
                F.when(removed, cell["good"]).otherwise(zero).alias("good_lost"),
                F.when(removed, cell["toxic"]).otherwise(zero).alias("toxic_lost"),
            )
            return F.struct(
                (alive & ~fails).alias("alive"),
                F.concat(state["steps"], F.array(counts)).alias("steps"),
            )

        start = F.struct(F.lit(True).alias("alive"), nothing.alias("steps"))
        return F.aggregate(order, start, step, lambda state: state["steps"])

    return F.flatten(F.transform(orders, along))


def interactions(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts of every order and step of the filters ``names`` (one letter each) for every part.

    ``counted`` has the columns part, mask, n, good and toxic; cells of one mask add up.
    Columns: part, filter_order, step (from 1), kept (after the step), removed, redundant
    (fails the filter but is gone), unique_fails (fails no other), good_lost, toxic_lost and
    shapley (removed by the step's filter, summed over all orders, at any step). Every part of
    ``counted`` has all orders and steps; no part, no row.
    """
    orders, texts = _orders(names)
    steps = len(names)
    whole = (
        counted.groupBy("part", "mask")
        .agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])
        .groupBy("part")
        # At most one cell for each mask.
        .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    )

    def add(x: Column, y: Column) -> Column:
        return F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS])

    zeros = F.array_repeat(
        F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), steps * len(texts)
    )
    merged = F.aggregate(
        "cells", zeros, lambda sums, cell: F.zip_with(sums, _folded(cell, orders), add)
    )
    filters = F.array(*[F.lit(text[i]) for text in texts for i in range(steps)])
    none = F.lit(0).cast("long")

    def share(name: str) -> Column:
        """What a filter removes in all orders."""
        own = F.zip_with(filters, "sums", lambda f, s: F.when(f == name, s["removed"]).otherwise(none))
        return F.aggregate(own, none, lambda total, x: total + x)

    shares = F.create_map(*itertools.chain.from_iterable((F.lit(n), share(n)) for n in names))
    rows = (
        whole.select("part", merged.alias("sums"))
        .select("part", "sums", shares.alias("shares"))
        .select("part", "shares", F.posexplode("sums").alias("place", "sums"))
    )
    order = F.element_at(F.array(*map(F.lit, texts)), F.expr(f"place DIV {steps}").cast("int") + 1)
    step = (F.col("place") % steps + 1).cast("int")
    return rows.select("part", "shares", "sums", order.alias("filter_order"), step.alias("step")).select(
        "part",
        "filter_order",
        "step",
        *[F.col("sums")[c].alias(c) for c in COUNTS],
        F.col("shares")[F.substring("filter_order", F.col("step"), F.lit(1))].alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The interactions of all five filters in every part of ``docs`` (doc_id, text, ``part``).

    A null part is the part named by the empty string. Null and empty texts fail by being
    short; very long texts are read whole; texts are equal if their SHA-256 is. Rows that repeat
    count as often as they come. Other columns are not read. An empty table has no part.
    """
    return interactions(*cells(docs, labels, part))
