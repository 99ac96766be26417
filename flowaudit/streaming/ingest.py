"""Streaming variants of ingest (S1/S6/S8) and batch scoring (M9).

The reference reads finite files only; this keeps the same operators usable
when capture files keep arriving in a folder: the file source reads new CSV
files with the *explicit* schema of the batch reader (no inference), rows get
the same day/label/numeric normalisation, and each micro-batch is scored by
a fitted model and appended to a parquet sink.  The checkpoint location is
required and must be a shared folder, so a restarted query resumes exactly
where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.labels import normalise_label
from ..functions.missing import nan_to_null
from ..sources.flows import clean_names_snake, clean_names_strip, day_from_file, dedupe_names


def read_flows_stream(spark: SparkSession, folder: str, header: str, names: str = "strip",
                      label: str = "Label", max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming twin of :func:`sources.flows.read_flows` for files sharing ``header``."""
    clean = clean_names_snake if names == "snake" else clean_names_strip
    cols = dedupe_names(clean(header.split(",")))
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    label_name = clean([label])[0]
    df = (spark.readStream.schema(schema).option("header", True).option("ignoreLeadingWhiteSpace", True)
          .option("maxFilesPerTrigger", max_files_per_trigger).csv(folder))
    day = "Day" if names == "strip" else "day"
    df = df.withColumn(day, day_from_file(F.col("_metadata.file_path")))
    df = df.drop(*[c for c in df.columns if c.endswith(".1")])
    df = df.withColumns({c: nan_to_null(F.expr(f"try_cast(`{c}` AS DOUBLE)"))
                         for c in df.columns if c not in (label_name, day)})
    return df.withColumn(label_name, normalise_label(label_name))


def score_stream(stream: DataFrame, model, sink_path: str, checkpoint: str, keep=(), trigger_once: bool = True):
    """M9 per micro-batch: ``model.score`` appended to parquet (exactly-once via checkpoint)."""
    def write_batch(batch: DataFrame, epoch: int) -> None:
        model.score(batch, keep=list(keep)).withColumn("epoch", F.lit(epoch)) \
             .write.mode("append").parquet(sink_path)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
