"""Incremental years with Structured Streaming: new landed files become polygon series.

The reference work is resumable year by year. Here the file source's checkpoint is the
record of what is done; each micro-batch is aggregated by the same batch plan and replaces
the partitions (source, year) that it brings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from catchment.plans.pipelines import aggregate_source, to_long
from catchment.sources.specs import SourceSpec
from catchment.sources.tables import write_series


def run_available(spark: SparkSession, landed: str, schema: str, weights: DataFrame, spec: SourceSpec, out: str, checkpoint: str, cell: tuple[str, ...] = ("iy", "ix")) -> StreamingQuery:
    """Work on all files that landed since the last run, then stop. A year must land in one run."""

    def one(batch: DataFrame, _: int) -> None:
        wide = aggregate_source(batch, weights, spec, cell=cell)
        names = [c for c in wide.columns if c not in ("hru", "t")]
        write_series(to_long(wide, spec.source, names), out)

    stream = spark.readStream.schema(schema).parquet(landed)
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
