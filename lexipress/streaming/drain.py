"""Poll loops as Structured Streaming: raw posts arrive as files, verdicts are appended by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedup, rules, verdict


def drain(spark: SparkSession, raw_path: str, schema: str, out_path: str, checkpoint: str, files_a_batch: int = 1, poll_seconds: int | None = None, file_format: str = "parquet", **rule_options) -> StreamingQuery:
    """Verdicts of all files under ``raw_path`` (one slice of ids each), below ``out_path``, a folder a batch.

    Without ``poll_seconds`` the query ends when everything there is done; with it, it looks
    again and again.  Kept posts go to a stored index beside the checkpoint, so a batch cleans
    and shingles its own posts alone.  A batch that is repeated overwrites what it wrote, and
    posts that have a verdict of another batch are left out.
    """
    stream = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_a_batch).load(raw_path)
    index = dedup.NearIndex(spark, f"{checkpoint}/near-index")

    def step(batch: DataFrame, number: int) -> None:
        done = _done(spark, out_path, number)
        todo = batch if done is None else verdict.pending(batch, done)
        verdict.verdicts(todo, index=index, run=str(number), **rule_options).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{poll_seconds} seconds") if poll_seconds else writer.trigger(availableNow=True)).start()


def _done(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """Ids that other batches have a verdict for."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema("id_raw_post long, batch int").parquet(path).where(f"batch <> {number}")
    except AnalysisException:
        return None


DEFAULT_RULES = rules.DEMO_RULES
