"""Structured Streaming: apply a fitted preparation to arriving listings.

Everything after the key merge is row-local given frozen parameters (P4), so
it runs unchanged on a streaming DataFrame: no state, no watermark needed.
The stream expects one record per key (the batch job's merge, D5, is the
stateful step and stays in batch). The sink is an append-only parquet folder
with its own checkpoint location, so a restarted query resumes exactly where
it stopped (files already committed are not re-emitted).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tableprep.config import PrepareConfig
from tableprep.operators import clean
from tableprep.plans import apply as AP
from tableprep.plans import prepare as PP


def stream_features(spark: SparkSession, source: str, schema: StructType, params: dict,
                    cfg: PrepareConfig = PrepareConfig(), max_files: int = 64) -> DataFrame:
    """Raw listing files arriving in `source` → feature rows (unbounded DataFrame)."""
    src = spark.readStream.schema(schema).option('maxFilesPerTrigger', max_files).parquet(source)
    rows = clean.remove_category(PP.cleaned(src, cfg), cfg.cols.property_type, cfg.out_of_scope_type)
    typed, _ = clean.convert_columns(rows, PP.CONVERSION_RULES)
    return AP.transform_typed(typed, params, cfg)


def start(features: DataFrame, sink: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write the stream to parquet; `once` processes what is there and stops."""
    w = (features.writeStream.format('parquet').outputMode('append')
         .option('checkpointLocation', checkpoint))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime='30 seconds')
    return w.start(sink)
