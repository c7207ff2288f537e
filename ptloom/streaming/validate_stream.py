"""Validate JSONL files as they arrive (Structured Streaming).

The reference reads its files line by line; every validation rule is a
stateless projection, so the same column expressions run on
``readStream.text``.  Each micro-batch is split into clean records and a
quarantine (with the error array) in two Parquet tables, and a per-batch
summary in a third, each with a partition folder per epoch.  A batch that is
replayed after a failure overwrites its own epoch's folders, so it is not
counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ptloom.operators import validate


def _put(df: DataFrame, folder: str, epoch_id: int) -> None:
    """Write one epoch's rows; a replay of the epoch replaces them."""
    df.drop("epoch").write.mode("overwrite").parquet(f"{folder}/epoch={epoch_id}")


def chat_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming source of raw lines with the path of their file."""
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(input_dir)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )


def start_chat_validation(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                          available_now: bool = True, require_assistant: bool = True) -> StreamingQuery:
    """Start the validation stream; ``available_now`` processes what is there and stops."""
    checked = validate.validate_chat(chat_stream(spark, input_dir), require_assistant=require_assistant)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        b = batch.persist()
        try:
            _put(b.where(F.col("ok")).drop("errors"), f"{output_dir}/clean", epoch_id)
            _put(b.where(~F.col("ok")), f"{output_dir}/quarantine", epoch_id)
            _put(validate.chat_summary(b), f"{output_dir}/summary", epoch_id)
        finally:
            b.unpersist()

    w = checked.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def start_preference_validation(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                                available_now: bool = True, strict_roles: bool = False) -> StreamingQuery:
    """Preference files as they arrive: validated and classified per line; clean
    records, quarantine and a per-batch, per-file summary (examples, errors,
    warnings) plus the rejected-type counts."""
    checked = validate.validate_preference(chat_stream(spark, input_dir), strict_roles=strict_roles)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        b = batch.persist()
        try:
            _put(b.where(F.col("ok")).drop("errors"), f"{output_dir}/clean", epoch_id)
            _put(b.where(~F.col("ok")), f"{output_dir}/quarantine", epoch_id)
            _put(validate.preference_file_summary(b), f"{output_dir}/summary", epoch_id)
            _put(b.where(F.col("rejected_type").isNotNull()).groupBy("file", "rejected_type").count(), f"{output_dir}/rejected_types", epoch_id)
        finally:
            b.unpersist()

    w = checked.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
