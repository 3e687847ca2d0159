"""Daily alert counts kept up to date from a stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.numbers import percent
from tidemark.operators.quality import kept
from tidemark.plans.kpis import is_alert
from tidemark.plans.silver import vitals_rule
from tidemark.sources import tables


def daily_alerts(readings: DataFrame) -> DataFrame:
    """Plausible readings and alerts per day, as a windowed aggregation.

    No reading is ever too late, as in the batch job, so there is no watermark; the state
    is one small row per day.
    """
    return (
        kept(readings, [vitals_rule()])
        .groupBy(F.window("ts", "1 day"))
        .agg(F.count("*").alias("nb_releves"), F.count_if(is_alert()).alias("nb_alertes"))
        .select(F.to_date("window.start").alias("jour"), "nb_releves", "nb_alertes")
    )


def maintain_daily_alerts(readings: DataFrame, target: str, checkpoint: str) -> None:
    """Bring the table at ``target`` up to date with all readings that have arrived; readers
    (``tables.read``) see the old counts until the new ones are complete."""

    def replace(batch: DataFrame, _: int) -> None:
        rate = percent(F.col("nb_alertes"), F.col("nb_releves"), 1)
        tables.rebuild(batch.withColumn("taux_alertes_pct", rate), target)

    query = (
        daily_alerts(readings)
        .writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
