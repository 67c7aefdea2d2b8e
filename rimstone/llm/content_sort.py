"""Exact duplicates by sorting whole normalised texts, in DataFrame functions only.

Sampled splitters deal the texts to range partitions, each partition sorts its texts outside memory, and equal texts,
which then stand side by side, are compared in full as one window. The splitter key is the first bytes of a text and
a hash of all of it, so that what the driver samples is short however long the texts are; the sort key ends in the whole
text, so that only texts that agree byte by byte are together.

A text whose copies weigh more than a partition should hold is dealt to several slots: the slot is a part of the splitter
key. Each slot finds its own best row, and one row per slot is compared afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from rimstone.llm.common import materialize, shuffles

# Fixed value: the characters that do not count, as SQL text of the two arguments of translate.
SPACES = " \u0009\u000a\u000b\u000c\u000d"
HEAD = 24  # characters of a text in the splitter key
ROW_BYTES = 64  # what a row weighs besides its text


def normalised(text: Column) -> Column:
    """The text without its white space; blanks, which are frequent, go by byte search."""
    spare = F.replace(F.coalesce(text, F.lit("")), F.lit(" "), F.lit(""))
    for c in SPACES[1:]:
        spare = F.when(F.contains(spare, F.lit(c)), F.replace(spare, F.lit(c), F.lit(""))).otherwise(spare)
    return spare


def heavy_texts(texts: DataFrame, parts: int) -> DataFrame | None:
    """`h`, `slots`: hashes of texts that weigh more than one `parts`-th of all, with how many slots they need.

    Fewer than `parts` texts can weigh that much, so the heaviest `parts` are all that the driver needs to see.
    """
    weight = F.sum(F.octet_length("norm").cast("long") + ROW_BYTES).alias("weight")
    seen = Observation()
    weights = texts.groupBy("h").agg(weight).observe(seen, F.sum("weight").alias("total"))
    first = weights.orderBy(F.desc("weight")).limit(parts).collect()
    if not first:
        return None
    share = max(seen.get["total"] // parts, 1)
    heavy = [f"({r['h']}L, {-(-r['weight'] // share)})" for r in first if r["weight"] > share]
    return texts.sparkSession.sql(f"select * from values {', '.join(heavy)} as t(h, slots)") if heavy else None


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256` for every row of `docs(doc_id, text)`.

    Texts are equal when they agree byte by byte after white space has been deleted; null counts as empty, and all
    empty texts are one group. Of a group the row with the most code points in its original text stays, then the one
    with the smallest doc_id, null last; of rows that agree in both, exactly one. Other columns are left out, whatever
    their names. An empty table gives no rows.
    """
    parts = shuffles(docs.sparkSession)
    texts = docs.select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_points"), normalised(F.col("text")).alias("norm")
    ).withColumn("h", F.xxhash64("norm"))
    heavy = heavy_texts(texts, parts)
    if heavy is None:
        slotted = texts.withColumn("slot", F.lit(0).cast("long"))
    else:
        spread = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), "slots")  # the same in a task that runs again
        # Fewer rows than partitions; see heavy_texts.
        slotted = texts.join(F.broadcast(heavy), "h", "left").withColumn("slot", F.coalesce(spread, F.lit(0).cast("long")))
        slotted = slotted.drop("slots")
    keyed = slotted.withColumn("head", F.substring("norm", 1, HEAD))
    dealt = keyed.repartitionByRange(parts, "head", "h", "slot")
    # The splitter key is part of the window's key, so the window needs no further exchange.
    equal = Window.partitionBy("head", "h", "slot", "norm")
    best_first = equal.orderBy(F.desc("n_points"), F.col("doc_id").asc_nulls_last())
    compared = dealt.select(
        "doc_id", "n_points", "slot", F.sha2("norm", 256).alias("text_sha256"),
        F.row_number().over(best_first).alias("nth"), F.first("doc_id").over(best_first).alias("keep_id"),
        F.count(F.lit(1)).over(equal).alias("group_size"),
    )
    if heavy is None:
        return compared.select("doc_id", "keep_id", "group_size", (F.col("nth") == 1).alias("kept"), "text_sha256")
    return across_slots(materialize(compared, "sorted-texts"), heavy, parts)


def across_slots(compared: DataFrame, heavy: DataFrame, parts: int) -> DataFrame:
    """The same with the groups of heavy texts put together from their slots: one row for each slot is compared."""
    best = F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "slot"))
    # A heavy text has at least two slots; texts of one slot are complete.
    slots = compared.where("nth = 1").groupBy("text_sha256").agg(
        best.alias("best"), F.sum("group_size").alias("whole_size"), F.max("slot").alias("last_slot")
    )
    whole = slots.where("last_slot > 0").select(
        "text_sha256", F.col("best.doc_id").alias("whole_keep"), F.col("best.slot").alias("best_slot"), "whole_size"
    )
    # At most one row for each heavy text, of which there are fewer than partitions.
    joined = compared.join(F.broadcast(whole), "text_sha256", "left")
    split = F.col("whole_size").isNotNull()
    return joined.select(
        "doc_id",
        F.when(split, F.col("whole_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("whole_size", "group_size").alias("group_size"),
        ((F.col("nth") == 1) & (~split | (F.col("slot") == F.col("best_slot")))).alias("kept"),
        "text_sha256",
    )
