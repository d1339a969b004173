"""The periodic load as a Structured Streaming query.

Loads are meant to be called again and again, each time for the rows that
arrived since the last call.  Here the source is a stream of new files and
each micro-batch is one load (``run_load`` with the batch as its extract) via
``foreachBatch``.  The stream's checkpoint remembers which files were loaded;
by default it lies in the shared folder under the names of job and target, so
each scheduled run goes on where the last one stopped.  A batch is known by its
checkpoint and number; one that is replayed after a failure is skipped when the
history already holds its FINISHED row without error.
``trigger(availableNow=True)`` gives one scheduled call that drains what is
new; ``processingTime`` keeps it running at a fixed interval.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.jobs import run_load
from tidemark.session import shared_dir
from tidemark.spec import JobSpec, SpecError


def stream_checkpoint(spark: SparkSession, job: str, target_table: str) -> str:
    """The folder that all runs of this job's stream into this target share, in this application and in later ones.

    It lies in the folder that ``spark.checkpoint.dir`` names, not in the one
    that Spark makes below it for each application.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or shared_dir(spark)
    return f"{root.rstrip('/')}/streams/{job}-{target_table}"


def already_loaded(spark: SparkSession, history_table: str, job: str, load_id: int, batch: str | None = None) -> bool:
    if not spark.catalog.tableExists(history_table):
        return False
    spark.catalog.refreshTable(history_table)
    done = spark.table(history_table).where(
        (F.col("job") == job) & (F.col("load_id") == load_id) & (F.col("status") == "FINISHED")
        & F.col("error").isNull())
    if batch is not None and "batch" in done.columns:
        done = done.where(F.col("batch") == batch)
    return not done.isEmpty()


def start_incremental_load(spark: SparkSession, spec: JobSpec, source_stream: DataFrame, *, target_table: str,
                           history_table: str | None = None, checkpoint: str | None = None,
                           interval: str | None = None, load_id_base: int = 0, user: str | None = None,
                           clock: Callable[[], dt.datetime] = dt.datetime.now,
                           plan: str = "auto") -> StreamingQuery:
    """Start the stream; each micro-batch is merged into ``target_table``, which a stream never rebuilds."""
    if spec.recreate:
        raise SpecError(f"{spec.name}: a stream adds to its target; rebuild it beforehand with recreate_target")
    checkpoint = checkpoint or stream_checkpoint(spark, spec.name, target_table)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = load_id_base + batch_id
        key = f"{checkpoint}#{batch_id}"
        if history_table and already_loaded(spark, history_table, spec.name, load_id, key):
            return
        now = clock()
        # The batch is the delta: no window filter, bounds recorded as the run time.
        run_load(batch.sparkSession, spec, now, now, load_id=load_id, now=now, user=user, source_df=batch,
                 target_table=target_table, history_table=history_table, apply_window=False, plan=plan, batch=key)
        # The stream runs in a cloned session; the caller's session caches
        # relations of its own, so point it at the new snapshot as well.
        for t in (target_table, history_table):
            if t and spark.catalog.tableExists(t):
                spark.catalog.refreshTable(t)

    writer = source_stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def file_stream(spark: SparkSession, directory: str, fmt: str = "parquet", glob: str | None = None,
                schema=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the files that appear in ``directory`` (schema from the files if not given)."""
    reader = spark.readStream.format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if schema is None:
        probe = spark.read.format(fmt)
        if glob:
            probe = probe.option("pathGlobFilter", glob)
        schema = probe.load(directory).schema
    return reader.schema(schema).load(directory)
