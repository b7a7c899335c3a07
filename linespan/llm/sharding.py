"""Sharding by Karmarkar-Karp differencing.

Equal texts form one indivisible group. A partial partition is a list of shard
loads; an item starts as one load and zeros. The two partial partitions with
the largest spread are combined, the heaviest load of one with the lightest of
the other, until one partition is left.

The number of items is bounded at every input size: a group of at least
1/``packs`` of all bytes is an item of its own (so there are at most ``packs``
of these), and every other group falls into one of ``packs`` packs by the hash
of its text, which is one item. Differencing therefore runs in one task over
at most ``2 * packs`` small rows, and its result is small enough to broadcast.
Rows never move by text: a group that holds a third of all rows is counted
before the shuffle and its rows find their shard by lookup.

A null text has no bytes and falls into the group of empty texts. Repeated
rows belong to one group and get slots of their own. An empty table gives no
rows. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linespan.llm.common import settle

SHARDS = 16
PACKS = 1 << 15
SLOT_ROWS = 8192


def difference(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item by Karmarkar-Karp differencing."""
    heap = []
    for number in sorted(range(len(sizes)), key=lambda n: (-sizes[n], n)):
        loads = [(sizes[number], number)] + [(0, None)] * (shards - 1)
        heap.append((-sizes[number], len(heap), loads))
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, first = heapq.heappop(heap)
        _, _, second = heapq.heappop(heap)
        combined = []
        for (a, held_a), (b, held_b) in zip(first, reversed(second), strict=True):
            # A load remembers its items as nested pairs.
            held = held_b if held_a is None else held_a if held_b is None else (held_a, held_b)
            combined.append((a + b, held))
        combined.sort(key=lambda load: -load[0])
        heapq.heappush(heap, (combined[-1][0] - combined[0][0], order, combined))
        order += 1
    result = [0] * len(sizes)
    for shard, (_, held) in enumerate(heap[0][2] if heap else []):
        waiting = [held]
        while waiting:
            part = waiting.pop()
            if isinstance(part, tuple):
                waiting.extend(part)
            elif part is not None:
                result[part] = shard
    return result


def shard_items(items: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` to items (item, bytes), whose number the caller has bounded."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(frames)
        if parts:
            every = pd.concat(parts).sort_values(["bytes", "item"], ascending=[False, True])
            every["shard"] = difference([int(x) for x in every["bytes"]], shards)
            yield every[["item", "shard"]]

    return items.select("item", "bytes").repartition(1).mapInPandas(run, "item string, shard int")


def assign(
    docs: DataFrame, *, identifier: Column, text: Column, shards: int = SHARDS, packs: int = PACKS,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Return id, size, text_crc32, shard and slot per row."""
    content = F.coalesce(text, F.lit(""))
    sized = settle(
        docs.select(
            identifier.alias("id"),
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.md5(content).alias("group"),
        ).withColumn("pack", F.pmod(F.xxhash64("group"), F.lit(packs))),
        "shard-sizes",
    )
    total = sized.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).first()
    groups = sized.groupBy("group", "pack").agg(F.sum("size").alias("bytes"))
    heavy = F.col("bytes") * packs >= (total["bytes"] or 0)
    item = F.when(heavy, F.concat(F.lit("g"), "group")).otherwise(F.concat(F.lit("p"), F.col("pack").cast("string")))
    items = groups.select(item.alias("item"), "bytes").groupBy("item").agg(F.sum("bytes").alias("bytes"))
    placed = settle(shard_items(items, shards), "shard-items")
    # Both tables have at most ``packs`` rows.
    own = placed.where("item LIKE 'g%'").select(F.expr("substring(item, 2)").alias("group"), F.col("shard").alias("own"))
    packed = placed.where("item LIKE 'p%'").select(
        F.expr("substring(item, 2)").cast("long").alias("pack"), F.col("shard").alias("shared")
    )
    parts = max(1, -(-total["rows"] // (shards * slot_rows)))
    rows = (
        sized.join(F.broadcast(own), "group", "left")
        .join(F.broadcast(packed), "pack", "left")
        .select(
            "id", "size", "text_crc32", "group", F.coalesce("own", "shared").alias("shard"),
            F.pmod(F.xxhash64("id", "group"), F.lit(parts)).alias("part"),
        )
    )
    # Slots: the rows of the parts before, then the place inside the part.
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("shard", "part", "start")
    )
    inside = Window.partitionBy("shard", "part").orderBy("id", "group")
    return rows.join(starts, ["shard", "part"]).select(
        "id", "size", "text_crc32", "shard", (F.col("start") + F.row_number().over(inside) - 1).alias("slot")
    )
