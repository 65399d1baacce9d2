"""Mixing sources to target weights by systematic sampling.

Each source gets a share of the mix by its weight, at most ``cap`` times its own
size; what a capped source leaves is shared among the others. Within a source
every document is expected ``target / source size`` times. The expected copies
are summed along the source's documents in order of (size, doc_id), one random
offset is added, and a document is emitted once for each integer the running
sum crosses. Along sizes, neighbours differ little, so the words taken miss the
target by no more than about one document.

Running sums are scanned in ranges of (source, size, doc_id), so a source with a
third of all rows is spread over as many tasks as its rows need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusweave.operators.scans import ordinals
from corpusweave.session import written

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixConfig:
    """``weights`` repeat along the sources in code point order, null last."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    cap: float = 2.0
    seed: str = "mix"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, config: MixConfig) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    The rounds of sharing move three sums to the driver each, never rows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_last", F.col("source").isNull())
    ranked = ordinals(totals, [], ["_last", "source"], "_rank")
    weights = F.array(*(F.lit(float(w)) for w in config.weights))
    ranked = written(
        ranked.select(
            "source", "source_size", F.element_at(weights, (F.col("_rank") % len(config.weights) + 1).cast("int")).alias("_w"),
            (F.col("source_size") * F.lit(config.cap)).alias("_cap"),
        ),
        "mix-sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        over = F.col("_w") * F.lit(level) > F.col("_cap")
        capped, free = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("_cap"))), F.lit(0.0)), F.sum(F.when(~over, F.col("_w")))
        ).first()
        if not free:
            break
        risen = (config.share * total - capped) / free
        if risen <= level:
            break
        level = risen
    return ranked.select("source", "source_size", F.least(F.col("_w") * F.lit(level), "_cap").alias("target"))


def _offset(source: Column, seed: str) -> Column:
    """The source's random offset in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix_sizes(sizes: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Copies of each row of ``sizes(doc_id, source, size)``.

    Adds ``source_size, target, copies``. Null is a source of its own. Rows that
    repeat are further documents, each with its own place in the order. Sources
    without words have target 0 and give no copies.
    """
    sizes = written(sizes.select("doc_id", "source", "size"), "mix-sizes")
    targets = source_targets(sizes, config).withColumnRenamed("source", "_source")
    placed = ordinals(sizes, ["source"], ["size", "doc_id"], "_n")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = _offset(F.col("source"), config.seed)
    crossed = F.floor(start + each * (F.col("_n") + 1)) - F.floor(start + each * F.col("_n"))
    return joined.withColumn("copies", crossed.cast("long")).drop("_n")


def mix(documents: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The documents of the mix, with the columns of ``documents``: a document
    taken twice comes as two rows, one not taken does not come.

    Rows that agree in doc_id, source and size share their copies evenly. Extra
    columns stay as they are. Texts move once, by doc_id.
    """
    keys = ["doc_id", "source", "size"]
    rows = documents.select(F.struct("*").alias("_row"), *(F.col(k) for k in ("doc_id", "source")), word_count(F.col("text")).alias("size"))
    copies = mix_sizes(rows.select(*keys), config).groupBy(*keys).agg(F.sum("copies").alias("_c"), F.count("*").alias("_m"))
    copies = copies.where("_c > 0").select(*(F.col(k).alias(f"_{k}") for k in keys), "_c", "_m")
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("size") == F.col("_size"))
    )
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(F.lit(0)))
    each = F.when(F.col("_m") == 1, F.col("_c")).otherwise(
        F.floor(F.col("_c") / F.col("_m")) + (F.col("_nth") <= F.col("_c") % F.col("_m")).cast("long")
    )
    taken = rows.join(copies, same).withColumn("_nth", nth).withColumn("_each", each.cast("int"))
    return taken.select(F.explode(F.array_repeat("_row", F.col("_each"))).alias("_row")).select("_row.*")


def mix_report(documents: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Words the mix takes from each row of ``documents``."""
    sizes = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix_sizes(sizes, config).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
