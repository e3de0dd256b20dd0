"""Resume-safe incremental generation (A10 + A11 + I1 on Structured Streaming)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kiln.operators.batch import apply_batch_fn
from kiln.session import checkpoint_dir
from kiln.sources.files import write_chunk


def run_incremental(spark: SparkSession, source_path: str, schema: T.StructType, fn: Callable[[list], list],
                    input_col: str, keys: list[str], out_path: str, name: str = "generate",
                    output_col: str = "response", fmt: str = "json", checkpoint: str | None = None,
                    max_files_per_trigger: int | None = None, attempts: int = 1, threads: int = 1):
    """Process every work file under ``source_path`` once, appending results to ``out_path``.

    * New files are picked up on each run (``availableNow``); Spark's
      checkpoint (under the shared ``spark.checkpoint.dir`` unless given)
      records which files are done, so a restarted job resumes (A10).
    * Each micro-batch writes its own ``chunk=<batch id>`` folder (A11) and
      replaces it if the batch is replayed (failure after writing, before
      committing), so nothing is written twice and earlier output is never
      read.  Failed calls are stored as null and count as done.
    """
    ckpt = checkpoint or checkpoint_dir(spark).rstrip("/") + f"/streams/{name}"
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    work = reader.load(source_path)

    def process(batch: DataFrame, batch_id: int) -> None:
        res = apply_batch_fn(batch, fn, input_col, output_col, attempts=attempts, backoff=2.0, threads=threads)
        write_chunk(res, out_path, batch_id)

    q = (work.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
