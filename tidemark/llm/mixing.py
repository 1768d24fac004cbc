"""Mixing sources to target weights: how many words each source should give, and the copies of documents that give them.

A document's size is its number of words (runs of characters other than blank and 0x09 to 0x0D); null counts as none.
Sources are ranked by code point with null last and weigh in turn by ``weights``. A source without words has the
target 0 and its documents are taken no times. Rows that repeat are drawn alike, as the draw depends on content only.
Texts of any length count whole. An empty table has no sources and gives no rows. Documents travel as one struct, so their
columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.quality_rules import words_of
from tidemark.llm.staging import staged

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL = 1.5
MOST = 2.0
SEED = "mix-1"


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """One row per source of ``sizes`` (mix_source, size): source_size, target, rate.

    All sources share ``total`` times all words by weight, none gets over ``most`` times its own. Pouring the excess
    out again until none is above ends at one level of words per unit of weight: sources in the order in which they
    fill up are capped as long as the level that the others would have is not below their cap. The two windows span
    one row per source, not documents.
    """
    per_source = sizes.groupBy("mix_source").agg(F.sum("size").alias("source_size"))
    ranked = Window.orderBy(F.col("mix_source").asc_nulls_last())
    number = (F.row_number().over(ranked) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (number + 1).cast("int"))
    frame = per_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("mix_source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    frame = frame.withColumns({
        "budget": F.sum("source_size").over(everything) * F.lit(total),
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    level = (F.col("budget") - F.col("cap_before")) / F.col("weight_left")
    frame = frame.withColumn("capped", F.col("cap") <= level * F.col("weight"))
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    full = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))
    target = F.when(F.col("capped"), F.col("cap")).otherwise((F.col("budget") - full) / free * F.col("weight"))
    frame = frame.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return frame.select("mix_source", "source_size", "target", rate.alias("rate"))


def draw(key: Column, text: Column, seed: str) -> Column:
    """A number from 0 to below 1 that depends on seed, key and text only."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def with_copies(docs: DataFrame, key="doc_id", text="text", source="source", weights=WEIGHTS, total=TOTAL, most=MOST, seed=SEED) -> DataFrame:
    """Every document as ``row`` with size, source_size, target and copies: floor(rate), and one more by a seeded draw.

    Rates are one row per source, written and read back, so that Spark knows their size: it broadcasts them if they
    are small and else joins by sort and splits the source that is hot.
    """
    sized = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[source].alias("mix_source"),
        F.size(words_of(docs[text])).cast("long").alias("size"), draw(docs[key], docs[text], seed).alias("drawn"),
    )
    rates = staged(targets(sized.select("mix_source", "size"), weights, total, most), "mixing-rates")
    rates = rates.withColumnRenamed("mix_source", "rate_source")
    joined = sized.join(rates, F.col("mix_source").eqNullSafe(F.col("rate_source")))
    copies = F.floor("rate") + (F.col("drawn") < F.col("rate") - F.floor("rate")).cast("long")
    return joined.select("row", "size", "source_size", "target", copies.cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns it came with."""
    taken = with_copies(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
