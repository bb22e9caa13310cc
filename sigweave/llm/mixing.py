"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

A source's documents form blocks. A source with weight w out of W gets w of every W slots;
its block j may run from slot floor((j - 1) W / w) on and must have run by slot
ceil(j W / w). Earliest deadline first among released blocks meets all deadlines when the
weights fill every slot, so at any slot each source is less than one block from its target.
The schedule repeats after W slots, hence one period per set of sources that still have
blocks describes it all; block numbers are looked up in it. When a source ends, a new phase
begins with the weights of the others, and the bound holds within each phase.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_DOCS = 16
# Documented bounds of the table of weights: named sources and the sum of their weights.
MOST_SOURCES = 256
MOST_WEIGHT = 10_000
REST = "\x00rest"
# Documents of a source that are numbered together.
BIN_DOCS = 128


def period(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slots of every source in one period (the sum of the weights) of the schedule."""
    total = sum(weights.values())
    released = {}
    for name, w in weights.items():
        for j in range(w):
            released.setdefault(j * total // w, []).append((-(-(j + 1) * total // w), name))
    slots: dict[str, list[int]] = {name: [] for name in weights}
    ready: list = []
    for t in range(total):
        for item in released.get(t, ()):
            heapq.heappush(ready, item)
        deadline, name = heapq.heappop(ready)
        slots[name].append(t)
    return slots


def phases(weights: dict[str, int], blocks: dict[str, int]) -> list[dict]:
    """Phases between the ends of sources.

    Each has start (its first slot), total, and per source first (blocks before it), count
    and slots (those of one period).
    """
    left = {name: n for name, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    start, found = 0, []
    while left:
        active = {name: weights[name] for name in left}
        total, slots = sum(active.values()), period(active)

        def last(name: str) -> int:
            full, rest = divmod(left[name] - 1, active[name])
            return full * total + slots[name][rest]

        end = min(map(last, left)) + 1
        full, rest = divmod(end, total)
        sources = {}
        for name in left:
            count = full * active[name] + sum(s < rest for s in slots[name])
            sources[name] = {"first": done[name], "count": count, "slots": slots[name]}
        found.append({"start": start, "total": total, "sources": sources})
        for name, part in sources.items():
            done[name] += part["count"]
            left[name] -= part["count"]
        left = {name: n for name, n in left.items() if n}
        start += end
    return found


def mixed(
    docs: DataFrame,
    weights: dict[str, int],
    rest_weight: int = 1,
    block_docs: int = BLOCK_DOCS,
    seed: int = 17,
) -> DataFrame:
    """All rows of ``docs`` with mix_source, block, slot and position.

    position (from 0, without gaps) is the place in the mixed order. ``weights`` maps sources
    to whole numbers; every other source and a null source share ``rest_weight``. A source's
    documents come in the order of a hash of doc_id, ``block_docs`` to a block, its last block
    may be short. No row is dropped or repeated; rows that repeat a doc_id follow each other
    in any order. Columns of ``docs`` with the new names are replaced. An empty table gives an
    empty result. Only the counts per source and bin come to plan the order: one number per
    named source reaches the driver.
    """
    if len(weights) > MOST_SOURCES or sum(weights.values()) + rest_weight > MOST_WEIGHT:
        raise ValueError(f"at most {MOST_SOURCES} sources with weights of {MOST_WEIGHT} in all")
    if rest_weight < 1 or min(weights.values(), default=1) < 1:
        raise ValueError("weights must be at least 1")
    weights = {**weights, REST: rest_weight}
    named = F.col("source").isin([w for w in weights if w != REST])
    keyed = docs.withColumn(
        "mix_source", F.when(named, F.col("source")).otherwise(F.lit(REST))
    ).withColumn("mix_order", F.xxhash64("doc_id", F.lit(seed)))
    counts = {r[0]: r[1] for r in keyed.groupBy("mix_source").count().collect()}
    if not counts:
        return _finished(keyed, F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"))
    # Equal shares of the hash range, in order: a hot source is numbered by many tasks.
    shares = [x for name, n in counts.items() for x in (F.lit(name), F.lit(-(-n // BIN_DOCS)))]
    keyed = keyed.withColumn("mix_bins", F.create_map(*shares)[F.col("mix_source")]).withColumn(
        "mix_bin", F.expr("shiftright(shiftrightunsigned(mix_order, 32) * mix_bins, 32)")
    )
    before = _before(
        keyed.groupBy("mix_source", "mix_bin").agg(
            F.first("mix_bins").alias("mix_bins"), F.count("*").alias("n")
        )
    )
    order = Window.partitionBy("mix_source", "mix_bin").orderBy(
        F.expr("shiftrightunsigned(mix_order, 1)"), "mix_order", "doc_id"
    )
    numbered = keyed.withColumn("mix_row", F.row_number().over(order)).join(
        before, ["mix_source", "mix_bin"]
    )
    index = F.col("mix_before") + F.col("mix_row") - 1
    blocks = {name: -(-n // block_docs) for name, n in counts.items()}
    plan = phases(weights, blocks)
    schedule = _schedule(docs, plan)
    # A row per named source: its size is bounded by MOST_SOURCES and MOST_WEIGHT.
    placed = (
        numbered.withColumn("mix_index", index)
        .withColumn("mix_block", F.expr(f"mix_index DIV {block_docs}"))
        .join(F.broadcast(schedule), "mix_source")
        .withColumn(
            "mix_phase",
            F.filter("mix_plan", lambda p: F.col("mix_block") < p["first"] + p["count"])[0],
        )
    )
    at = F.expr("mix_block - mix_phase.first")
    size = F.size("mix_phase.slots")
    slot = F.expr("mix_phase.start") + F.floor(at / size) * F.expr("mix_phase.total") + F.expr(
        "mix_phase.slots[CAST((mix_block - mix_phase.first) % size(mix_phase.slots) AS INT)]"
    )
    placed = placed.withColumn("mix_slot", slot.cast("long"))
    short = F.lit(0).cast("long")
    for name, last in _last_slots(plan, blocks).items():
        missing = blocks[name] * block_docs - counts[name]
        if missing:
            short = short + F.when(F.col("mix_slot") > last, missing).otherwise(0)
    position = F.col("mix_slot") * block_docs + F.col("mix_index") % block_docs - short
    return _finished(placed, F.col("mix_block"), F.col("mix_slot"), position)


def _before(bins: DataFrame) -> DataFrame:
    """mix_source, mix_bin and mix_before, the documents of the source in earlier bins.

    Bins form groups of the square root of their number, and sums run over the groups of a
    source and over the bins of a group: no window holds all bins of a hot source.
    """
    bins = bins.withColumn(
        "mix_group", F.expr("mix_bin DIV CAST(ceil(sqrt(mix_bins)) AS BIGINT)")
    )

    def earlier(*part: str) -> WindowSpec:
        return Window.partitionBy(*part[:-1]).orderBy(part[-1]).rowsBetween(
            Window.unboundedPreceding, -1
        )

    groups = (
        bins.groupBy("mix_source", "mix_group")
        .agg(F.sum("n").alias("n"))
        .select(
            "mix_source",
            "mix_group",
            F.coalesce(F.sum("n").over(earlier("mix_source", "mix_group")), F.lit(0)).alias("first"),
        )
    )
    inside = F.coalesce(F.sum("n").over(earlier("mix_source", "mix_group", "mix_bin")), F.lit(0))
    return (
        bins.withColumn("inside", inside)
        .join(groups, ["mix_source", "mix_group"])
        .select("mix_source", "mix_bin", (F.col("first") + F.col("inside")).alias("mix_before"))
    )


def _finished(rows: DataFrame, block: Column, slot: Column, position: Column) -> DataFrame:
    rows = rows.withColumns({"block": block, "slot": slot, "position": position.cast("long")})
    rows = rows.withColumn(
        "mix_source", F.when(F.col("mix_source") != REST, F.col("mix_source"))
    )
    made = "order bins bin before row index block plan phase slot".split()
    return rows.drop(*(f"mix_{c}" for c in made))


def _schedule(docs: DataFrame, plan: list[dict]) -> DataFrame:
    rows: dict[str, list] = {}
    for phase in plan:
        for name, part in phase["sources"].items():
            if part["count"]:
                rows.setdefault(name, []).append(
                    (part["first"], part["count"], phase["start"], phase["total"], part["slots"])
                )
    return docs.sparkSession.createDataFrame(
        list(rows.items()),
        "mix_source string, mix_plan array<struct<first:long,count:long,start:long,total:long,"
        "slots:array<long>>>",
    )


def _last_slots(plan: list[dict], blocks: dict[str, int]) -> dict[str, int]:
    found = {}
    for phase in plan:
        for name, part in phase["sources"].items():
            if part["count"] and part["first"] + part["count"] == blocks[name]:
                full, rest = divmod(part["count"] - 1, len(part["slots"]))
                found[name] = phase["start"] + full * phase["total"] + part["slots"][rest]
    return found
