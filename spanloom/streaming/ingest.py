"""Continuous ingest of a folder of trace files."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.plans.ingest import ingest
from spanloom.sources.stage import remove_stages, stage_folder
from spanloom.sources.store import write_ops
from spanloom.sources.trace import number_lines

_TOTALS = "lines bigint, records bigint, rejects bigint, orphans bigint, seconds double"


def stream_ingest(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    available_now: bool = True,
    ids: str = "hash",
    zone: str = "UTC",
    attach_lobs: bool = False,
    **options: str,
) -> StreamingQuery:
    """Append every new trace file of ``folder`` to the fact table at ``target``, what was not stored to the
    tables ``_rejects`` and ``_orphans`` in it, and a row of totals per batch to ``_totals``.

    Files are independent of each other, so a batch needs no state of earlier ones: the whole batch
    ingest runs per micro-batch. Files must appear complete (moved into the folder), since the
    source does not follow growing files. A batch has a sub-folder of its own in each table, named by
    the checkpoint and the batch: it replaces what a failed try of the same batch left, and never what
    another stream wrote to the same target. Staged tables of a batch are removed at its end. Dense
    ids start anew with every batch and are refused.
    """
    if ids == "dense":
        raise ValueError("dense ids number the spans of one ingest; a stream has many")
    stream = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint.rstrip("/")).hex
    reader = spark.readStream.format("text").options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    text = reader.load(folder).select(
        "value",
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_split"),
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        own = f"stream={stream}/batch={batch_id}"
        begun = time.monotonic()
        with stage_folder(batch.sparkSession, f"{stream}-{batch_id}"):
            lines = number_lines(batch.withColumn("_at", F.monotonically_increasing_id()))
            done = ingest(lines, ids=ids, zone=zone, attach_lobs=attach_lobs)
            write_ops(done.ops, f"{target}/{own}", mode="overwrite", version_row=False)
            done.rejects.write.mode("overwrite").parquet(f"{target}/_rejects/{own}")
            done.orphans.write.mode("overwrite").parquet(f"{target}/_orphans/{own}")
            t = done.totals
            row = [(t.lines, t.records, t.rejects, t.orphans, time.monotonic() - begun)]
            totals = batch.sparkSession.createDataFrame(row, _TOTALS)
            totals.coalesce(1).write.mode("overwrite").parquet(f"{target}/_totals/{own}")
        remove_stages(batch.sparkSession, f"{stream}-{batch_id}")

    writer = text.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
