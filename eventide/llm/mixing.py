"""Mixing sources to target weights by capped water-filling.

Source ``s`` with weight ``w`` and size ``n`` (words) gets ``min(level * w,
max_epochs * n)`` words. ``level`` is where clamping the small sources at their
maximum and handing the excess to the others in proportion to weight comes to
rest: with the sources in order of ``cap / w``, it is the first
``(total - caps before) / (weights from here on)`` that does not pass its own
source's ``cap / w``. All of that is window arithmetic over one row per source.

A source's target is made of whole repetitions of all its documents and one
fractional one: its documents in a seeded random order (md5 of seed and id), up
to the words that are missing. The running sum of a source runs in two levels,
(source, hash cell) sums and then inside each cell, so a source with a third of
all rows is spread over all tasks.

Null text has size 0; null is a source of its own, ordered last; documents
without words are never taken; rows that repeat an id get the same place in
the order and are told apart by their text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.textops import WORD

CELL_DIGITS = 3        # hex digits of the order hash that name a cell: 4,096 cells a source
MAX_EPOCHS = 3
SEED = "mix-0"


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), 1)).cast("long")


def targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source, source_size`` -> the same with ``weight, target``; weights repeat
    over the sources in code point order, null last."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("_rn", F.row_number().over(by_name))
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                            (F.pmod(F.col("_rn") - 1, F.lit(len(weights))) + 1).cast("int")))
    w = w.withColumn("_cap", F.col("source_size") * max_epochs)
    w = w.withColumn("_ratio", F.col("_cap").cast("double") / F.col("weight"))
    order = Window.orderBy("_ratio", "_rn")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("_total", F.sum("source_size").over(everything))
    w = w.withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double")
                     / F.sum("weight").over(onward))
    w = w.withColumn("_k", F.row_number().over(order))
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_k", "_level"))
    w = w.withColumn("_level", F.min(fits).over(everything)["_level"])
    target = F.least(F.col("_level") * F.col("weight"), F.col("_cap").cast("double"))
    return w.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = (1, 2, 3), seed: str = SEED,
        cell_digits: int = CELL_DIGITS) -> DataFrame:
    """``doc_id``, ``row`` (all columns of ``docs``, which has ``doc_id, text,
    source`` and any more, as one struct, so their names cannot clash), ``_size,
    _source_size, _target, _reps`` (times the mix takes the document)."""
    rows = (docs.select("doc_id", "text", "source", F.struct("*").alias("row")).withColumn("_size", n_words(F.col("text")))
            .withColumn("_order", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
            .withColumn("_cell", F.substring("_order", 1, cell_digits))
            .withColumn("_tie", F.md5(F.coalesce(F.col("text"), F.lit("")))))
    key = F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()
    rows = rows.withColumn("_src", key[0]).withColumn("_none", key[1])
    cells = rows.groupBy("_src", "_none", "_cell").agg(F.sum("_size").alias("_in_cell"))
    sizes = (cells.groupBy("_src", "_none").agg(F.sum("_in_cell").alias("source_size"))
             .withColumn("source", F.when(~F.col("_none"), F.col("_src"))))
    aim = (targets(sizes.select("source", "source_size"), max_epochs, weights)
           .select(key[0].alias("_src"), key[1].alias("_none"), F.col("source_size").alias("_source_size"),
                   F.col("target").alias("_target")))
    ahead = Window.partitionBy("_src", "_none").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cells.withColumn("_ahead", F.coalesce(F.sum("_in_cell").over(ahead), F.lit(0)))
               .join(aim, ["_src", "_none"])
               .select("_src", "_none", "_cell", "_ahead", "_source_size", "_target"))
    inside = (Window.partitionBy("_src", "_none", "_cell").orderBy("_order", "_tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("_before", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
              .join(offsets, ["_src", "_none", "_cell"]))
    whole = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0)
    rest = F.col("_target") - F.col("_whole") * F.col("_source_size")
    extra = (F.col("_ahead") + F.col("_before")) * 2 + F.col("_size") <= rest * 2
    reps = F.when(F.col("_size") == 0, 0).otherwise(F.col("_whole") + F.when(extra, 1).otherwise(0))
    return (placed.withColumn("_whole", whole)
            .select("doc_id", "row", "_size", "_source_size", "_target", reps.cast("long").alias("_reps")))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, with the columns of ``docs``."""
    return (mix(docs, **options).where(F.col("_reps") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_reps")))).select("row.*"))
