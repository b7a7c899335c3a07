"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources are weighted in code-point order (null last). Targets share a budget
by weight; a target stops at ``repeats`` times its source's size and the
excess is shared again by weight. Blocks of equal words are allocated to the sources by
highest quotients (target / (2k - 1)). A source's documents are dealt to shards by
a seeded hash, as many shards as its documents fill, and its blocks are allocated to its shards, by way of groups
of shards, in the same manner: the integer quotas of the shards sum to the source's
blocks, so rounding does not add up over shards and a thin source is not lost. In a shard the
words form one stream in seeded order, cut into blocks, and a seeded run of
blocks is taken: whole passes over the stream first, then one run from a
seeded start. So a document on the edge of a run is taken in part, and none
is taken more than ``repeats`` times.

A null text has size 0; documents of size 0 are never taken. Repeated rows lie
side by side in a stream and count each for itself. Very long texts count with all their words; a shard
may hold one alone. Equal quotients go to the source or shard that comes first. Everything depends on
content and seed only, so reruns agree. An empty table gives no rows. Only the
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linespan.llm.common import keyed, settle, words_of

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
REPEATS = 2
BLOCK_WORDS = 16
SHARD_ROWS = 4_096
# Shards of a group, which bounds the rows compared at a time.
GROUP_SHARDS = 4_096
SEED = "mix-1"


def _number(hexed: Column) -> Column:
    """The first 32 bits of a hex digest."""
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Return place, weight, source_size and target per source.

    ``sizes``: source_key, source, source_size. One row a source, so the
    windows over all sources see one small row for each.
    """
    everything = Window.partitionBy()
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = (
        sizes.withColumn("place", F.row_number().over(in_order))
        .withColumn(
            "weight",
            F.element_at(
                F.array(*(F.lit(w) for w in WEIGHTS)), ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int")
            ).cast("long"),
        )
        .withColumn("cap", F.col("source_size") * REPEATS)
        .withColumn("budget", F.sum("source_size").over(everything) * BUDGET_PERCENT / 100.0)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    # Sources fill up in the order of cap per weight; before each, the level
    # at which the rest of the budget covers the sources not yet full. It rises up to
    # the first source it cannot fill, then falls.
    filling = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        ranked.withColumn("cap_before", F.coalesce(F.sum("cap").over(filling), F.lit(0)))
        .withColumn(
            "weight_left",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0)),
        )
        .withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("weight_left"))
        .withColumn("full", F.col("ratio") <= F.col("level"))
        .withColumn("final_level", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
    )
    target = F.when(
        F.col("full") | F.col("final_level").isNull(), F.col("cap").cast("double")
    ).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("final_level")))
    return levels.select("source_key", "place", "weight", "source_size", target.alias("target"))


def highest_quotients(offers: DataFrame, parent: list[str], child: list[str]) -> DataFrame:
    """Allocate the seats of each parent to its children: parent, child and quota.

    ``offers``: parent, child, place, share (the child's exact part of the seats) and seats. The divisor
    that fills N seats differs from 1 by at most S / 2N for S children, so a
    quota is within share / N * S / 2 + 1/2 of the share. Seats below that range
    are certain and only the quotients inside it compete, about 4 S rows.
    """
    own = Window.partitionBy(*parent)
    bounded = (
        offers.withColumn(
            "slack",
            F.ceil(F.col("share") / F.greatest("seats", F.lit(1)) * F.count(F.lit(1)).over(own) / 2).cast("long") + 2,
        )
        .withColumn("certain", F.greatest(F.lit(0), F.floor("share").cast("long") - F.col("slack")))
        .withColumn("open", F.col("seats") - F.sum("certain").over(own))
    )
    competing = bounded.select(
        "*",
        F.explode(
            F.sequence(F.col("certain") + 1, F.floor("share").cast("long") + 1 + F.col("slack"))
        ).alias("seat"),
    ).withColumn("quotient", F.col("share") / (2 * F.col("seat") - 1))
    order = own.orderBy(F.desc("quotient"), "place", "seat")
    won = (
        competing.withColumn("rank", F.row_number().over(order))
        .groupBy(*parent, *child)
        .agg(
            F.first("certain").alias("certain"),
            F.count(F.when(F.col("rank") <= F.col("open"), 1)).alias("won"),
        )
    )
    return won.select(*parent, *child, (F.col("certain") + F.col("won")).alias("quota"))


def source_blocks(targets: DataFrame, block_words: int) -> DataFrame:
    """Blocks of each source: source_key and quota. ``targets`` has one small row a source."""
    shares = targets.where("target > 0").withColumn("share", F.col("target") / block_words)
    # Sums of whole thousandths do not depend on the order of adding.
    thousandths = F.sum(F.floor(F.col("share") * 1000).cast("long")).over(Window.partitionBy("mix"))
    seats = F.floor((thousandths + 500) / 1000).cast("long")
    return highest_quotients(
        shares.withColumn("mix", F.lit(0)).withColumn("seats", seats).select("mix", "source_key", "place", "share", "seats"),
        ["mix"], ["source_key"],
    ).drop("mix")


def shard_quotas(supply: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks of each shard: source_key, shard and quota.

    ``supply``: source_key, shard and supply (words, above 0); ``blocks``: source_key and quota.
    """
    grouped = supply.withColumn("group", F.expr(f"shard div {GROUP_SHARDS}"))
    groups = grouped.groupBy("source_key", "group").agg(F.sum("supply").alias("supply"))

    def shares(children: DataFrame, parent: list[str], place: str) -> DataFrame:
        whole = F.sum("supply").over(Window.partitionBy(*parent))
        return children.withColumn("place", F.col(place)).withColumn(
            "share", F.col("seats").cast("double") * F.col("supply") / whole
        )

    by_group = highest_quotients(
        shares(groups.join(blocks.withColumnRenamed("quota", "seats"), "source_key"), ["source_key"], "group"),
        ["source_key"], ["group"],
    )
    parent = ["source_key", "group"]
    return highest_quotients(
        shares(grouped.join(by_group.withColumnRenamed("quota", "seats"), parent), parent, "shard"), parent, ["shard"]
    ).drop("group")


def mix(
    docs: DataFrame, *, key: list[str], text: Column, source: Column, identifier: Column,
    block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: str = SEED,
) -> DataFrame:
    """Return key columns, size, source_size, target, shard, quota and taken per row."""
    measured = settle(
        docs.select(
            *key,
            source.alias("mix_source"),
            F.coalesce(F.concat(F.lit("s"), source), F.lit("none")).alias("source_key"),
            F.size(words_of(text)).cast("long").alias("size"),
            F.md5(
                F.concat_ws(
                    ":", F.lit(seed), F.coalesce(identifier.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
                )
            ).alias("draw"),
        ),
        "mix-sizes",
    )
    sources = measured.groupBy("source_key").agg(
        F.first("mix_source").alias("source"), F.sum("size").alias("source_size"),
        F.count_if(F.col("size") > 0).alias("filled"),
    )
    shards = F.greatest(F.lit(1), F.ceil(F.col("filled") / shard_rows).cast("long"))
    filled = sources.select("source_key", shards.alias("shards"))
    targets = settle(source_targets(sources.drop("filled")).join(filled, "source_key"), "mix-targets")
    rows = measured.join(targets, "source_key").withColumn("shard", F.pmod(_number(F.col("draw")), F.col("shards")))
    supply = settle(
        rows.where("size > 0").groupBy("source_key", "shard").agg(F.sum("size").alias("supply")), "mix-supply"
    )
    quotas = shard_quotas(supply, source_blocks(targets, block_words))
    drawn = _number(F.md5(F.concat_ws(":", F.lit(seed), "source_key", F.col("shard").cast("string"))))
    plan = settle(
        supply.join(quotas, ["source_key", "shard"], "left")
        .withColumn("quota", F.coalesce("quota", F.lit(0)))
        .withColumn("words", F.least(F.col("quota") * block_words, F.col("supply") * REPEATS))
        .select(
            "source_key", "shard", "quota", "supply",
            F.expr("words div supply").alias("passes"), F.expr("words % supply").alias("run"),
            (F.pmod(drawn, F.ceil(F.col("supply") / block_words)) * block_words).alias("start"),
        ),
        "mix-plan",
    )
    stream = (
        Window.partitionBy("source_key", "shard").orderBy("draw", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.where("size > 0").withColumn("end", F.sum("size").over(stream)).withColumn(
        "begin", F.col("end") - F.col("size")
    )
    run_end = F.col("start") + F.col("run")

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least("end", high) - F.greatest("begin", low))

    taken = (
        F.col("passes") * F.col("size")
        + overlap(F.col("start"), F.least(run_end, F.col("supply")))
        + overlap(F.lit(0), run_end - F.col("supply"))
    )
    columns = [*key, "size", "source_size", "target", "shard"]
    used = placed.join(plan, ["source_key", "shard"]).select(*columns, "quota", taken.cast("long").alias("taken"))
    # Documents without words have no place in a stream.
    empty = rows.where("size = 0").select(
        *columns, F.lit(0).cast("long").alias("quota"), F.lit(0).cast("long").alias("taken")
    )
    return used.unionByName(empty)


def mixed_rows(docs: DataFrame, *, text: str = "text", source: str = "source", identifier: str = "doc_id") -> DataFrame:
    """Return whole rows, each as often as the mix takes it.

    A document on the edge of a run is taken whole when at least half of it
    lies in the run, else not.
    """
    stored = keyed(docs, "mix-rows")
    plan = mix(
        stored, key=["row_key"], text=F.col(f"doc.`{text}`"), source=F.col(f"doc.`{source}`"),
        identifier=F.col(f"doc.`{identifier}`"),
    )
    copies = plan.where("taken > 0").select(
        "row_key", F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("int").alias("copies")
    ).where("copies > 0")
    return (
        stored.join(copies, "row_key")
        .select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
        .select("doc.*")
    )
