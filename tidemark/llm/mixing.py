"""Mixing sources to target weights: systematic sampling of documents.

Every document of a source is expected ``target / source size`` times. The documents of a
source are put in order of size, the expected copies are summed along that order, one
pseudo-random offset per source is added, and a document is emitted once for every whole
number its stretch crosses. Half of the documents (by a hash) come first by rising size, the
other half after them by falling size: whatever the offset, what one half gives too much the
other gives too little, so the words taken follow the target closely.

Expected copies are kept in whole units of 2 ** -UNIT_BITS and the sums are products of a
row number and such a whole number, so no rounding can lose, add or repeat a document, and
reruns agree. In a small source one long document outweighs many, so DRAWS offsets are drawn,
spread evenly from a seeded one, and the one whose words come nearest to the target is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import blocked, positioned, ready, written
from tidemark.llm.texts import word_count

WEIGHTS = (5, 2, 1)
#: A source gives at most this many times its own size.
MOST = 3
UNIT_BITS = 20
#: Offsets drawn per source.
DRAWS = 16


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source_size`` per ``source`` to ``target``: weighted shares of the total, none above
    ``most`` times the source, what is cut off shared out again by weight.

    Sources count by code point, null last, with ``weights`` in rotation. The shares that
    remain are ``level * weight``; a source is capped if its cap per weight is below the
    level that the sources capped before it leave. One row per source is handled here, not
    one per document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("long")
    ranked = sizes.select("source", "source_size", weight.alias("weight"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # cap / weight < left / heavy, in whole numbers
    ranked = ranked.withColumn("capped", F.col("cap") * F.col("heavy") < F.col("left") * F.col("weight"))
    level = F.max(F.when(~F.col("capped"), F.struct("heavy", (F.col("left") / F.col("heavy")).alias("level")))).over(whole)
    share = F.coalesce(level["level"] * F.col("weight"), F.lit(0.0))
    return ranked.select(
        "source",
        "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def copies_of(position: Column, units: Column, offset: Column) -> Column:
    """Whole numbers crossed by the stretch of the row at ``position`` (from 0)."""

    def floor(row: Column) -> Column:
        return F.shiftright(row * units + offset, UNIT_BITS)

    return floor(position + 1) - floor(position)


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", word_count(F.col("text")))


def _taken(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, source, size`` and more, a written table) with ``source_size``,
    ``target`` and ``copies``."""
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    # a null source gets a key that no text has
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    falling = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 1) >= "8"
    rows = rows.withColumns({"_key": key, "_half": falling, "_size": F.when(falling, -F.col("size")).otherwise(F.col("size"))})
    order = ["_half", "_size", "doc_id"]
    table, blocks = blocked(rows.repartitionByRange("_key", *order), ["_key"], "mixing", order=order)
    ratio = F.floor(F.col("target") / F.col("source_size") * (1 << UNIT_BITS) + 0.5).cast("long")
    units = F.when(F.col("source_size") > 0, F.least(ratio, F.lit(MOST << UNIT_BITS))).otherwise(F.lit(0))
    digits = F.substring(F.md5(F.coalesce("source", F.lit("")).cast("binary")), 1, UNIT_BITS // 4)
    offset = F.conv(digits, 16, 10).cast("long")
    targets = targets.select(
        key.alias("_key"), "source_size", "target", units.cast("long").alias("_units"), offset.alias("_offset")
    )
    drawn = [F.pmod(F.col("_offset") + (number << UNIT_BITS) // DRAWS, F.lit(1 << UNIT_BITS)) for number in range(DRAWS)]
    words = positioned(table, blocks.join(targets, "_key"), ["_key"])
    totals = words.groupBy("_key").agg(
        *[F.sum(copies_of(F.col("position"), F.col("_units"), at) * F.col("size")).alias(f"_words_{number}") for number, at in enumerate(drawn)]
    )
    far = [F.struct(F.abs(F.col(f"_words_{number}") - F.col("target")).alias("far"), F.lit(number).alias("n"), at.alias("at")) for number, at in enumerate(drawn)]
    chosen = targets.join(totals, "_key").withColumn("_offset", F.array_min(F.array(*far))["at"]).drop(*[f"_words_{n}" for n in range(DRAWS)])
    mixed = positioned(table, blocks.join(chosen, "_key"), ["_key"])
    return mixed.withColumn("copies", copies_of(F.col("position"), F.col("_units"), F.col("_offset")))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies``.

    ``size`` counts words; a null or empty text has none and may still be copied, which takes
    no words. A null source is a source. Equal documents, and equal rows, are taken
    independently, at most MOST times each. An empty table gives an empty table. Ties in size
    are ordered by ``doc_id``, so which of two equal rows is copied does not matter. Other
    columns are not read.
    """
    ready(docs.sparkSession)
    rows = written(_sized(docs.select("doc_id", "source", "text")).drop("text"), "sizes")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return _taken(rows).select("doc_id", "size", "source_size", "target", taken, "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all its columns kept.

    Null and empty texts, null sources, ties, equal rows and empty tables are as in ``mix``;
    columns named like those of ``mix`` keep their own values.
    """
    ready(docs.sparkSession)
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row")
    whole = _sized(docs.select("doc_id", "source", "text", row)).drop("text")
    whole = written(whole.withColumn("_id", F.monotonically_increasing_id()), "whole")
    copies = _taken(whole.select("doc_id", "source", "size", "_id")).where("copies > 0").select("_id", "copies")
    copied = whole.select("_row", "_id").join(copies, "_id")
    return copied.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
