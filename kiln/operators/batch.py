"""User batch functions (I1) and visible batching.

Model calls are outside kiln: a user function maps a list of inputs (a
message list or prompt each) to a list of outputs.  kiln runs it inside
``mapInPandas`` so Spark partitions the work and Arrow moves the data;
concurrency is partitions x ``threads``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def _caller(fn: Callable[[list], list], attempts: int, backoff: float) -> Callable:
    """``fn`` on one item: its answer, or None after ``attempts`` failures with ``backoff ** n`` seconds between them."""
    def call(item):
        for n in range(attempts):
            try:
                return fn([item])[0]
            except Exception:
                if n + 1 < attempts and backoff:
                    time.sleep(backoff ** n)
        return None

    return call


def apply_batch_fn(df: DataFrame, fn: Callable[[list], list], input_col: str, output_col: str = "response",
                   attempts: int = 1, backoff: float = 2.0, threads: int = 1, per_item: bool = True,
                   output_type: T.DataType = T.StringType(), partitions: int | None = None,
                   key: str | None = None) -> DataFrame:
    """Apply ``fn`` to every row's ``input_col``; the result is keyed to its row.

    An item whose call raises gets null (after ``attempts`` tries with
    ``backoff ** n`` seconds between them); nulls are kept, never dropped.
    ``per_item`` calls ``fn([x])`` per row (isolating failures) using
    ``threads`` concurrent calls per task; otherwise one call per Arrow batch.
    ``partitions`` (hashing on ``key`` when given) sets how many tasks call the
    model at once: total concurrency = partitions x threads.
    """
    if partitions:
        df = df.repartition(partitions, key) if key else df.repartition(partitions)
    schema = T.StructType(df.schema.fields + [T.StructField(output_col, output_type)])

    call = _caller(fn, attempts, backoff)

    def run(batches):
        pool = ThreadPoolExecutor(max_workers=threads) if threads > 1 else None
        try:
            for pdf in batches:
                items = pdf[input_col].tolist()
                items = [x.tolist() if hasattr(x, "tolist") else x for x in items]
                if per_item:
                    out = list(pool.map(call, items)) if pool else [call(x) for x in items]
                else:
                    try:
                        out = list(fn(items))
                    except Exception:
                        out = [None] * len(items)
                pdf[output_col] = out
                yield pdf
        finally:
            if pool:
                pool.shutdown()

    return df.mapInPandas(run, schema)


def committed_calls(df: DataFrame, fn: Callable[[list], list], input_col: str, key: str, output_col: str = "response",
                    every: int = 50, attempts: int = 1, backoff: float = 2.0, threads: int = 1,
                    output_type: T.DataType = T.StringType(), partitions: int | None = None, run: str | None = None) -> DataFrame:
    """I1 + A11 within a task: as ``apply_batch_fn``, but results are committed every ``every`` calls.

    The work is written first, numbered within its partitions by ``key``;
    ``every`` rows in a row are a block.  A task writes a block's results as
    one file of the shared folder, under a hidden name that becomes the
    block's own once it is whole, and passes over blocks whose file is there.
    So a task that is lost, however late, repeats ``every`` calls at the most;
    a second attempt beside a first one writes the same files.  ``run`` names
    the folder: calling again with the same ``run`` after the job itself was
    lost goes on where it stopped, with the work as it was first written.

    Each Python worker opens the folder itself (``pyarrow.fs``).  Returns all
    columns of ``df`` and the result; ``key`` must tell rows apart.
    """
    from kiln.session import checkpoint_dir

    spark = df.sparkSession
    root = run.rstrip("/") if run else f"{checkpoint_dir(spark)}/kiln-calls-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/work/_SUCCESS")
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        ranged = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
        at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        numbered = ranged.sortWithinPartitions(key).withColumn("_part", F.spark_partition_id()).withColumn("_block", F.floor(at / every))
        numbered.write.mode("overwrite").parquet(f"{root}/work")
    schema = T.StructType(df.schema.fields + [T.StructField("_part", T.IntegerType()), T.StructField("_block", T.LongType())])
    work = spark.read.schema(schema).parquet(f"{root}/work")
    result = T.StructType(df.schema.fields + [T.StructField(output_col, output_type)])
    arrow = to_arrow_schema(result)
    call = _caller(fn, attempts, backoff)

    def commit(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        folder = f"{base}/results"
        store.create_dir(folder, recursive=True)
        pool = ThreadPoolExecutor(max_workers=threads) if threads > 1 else None

        def finish(name, table):
            target = f"{folder}/{name}.parquet"
            if store.get_file_info(target).type != fs.FileType.NotFound:
                return 0
            items = table.column(input_col).to_pylist()
            out = list(pool.map(call, items)) if pool else [call(x) for x in items]
            table = table.append_column(output_col, pa.array(out, arrow.field(output_col).type)).select(arrow.names).cast(arrow)
            hidden = f"{folder}/_{name}-{uuid.uuid4().hex}"
            with store.open_output_stream(hidden) as sink:
                pq.write_table(table, sink)
            store.move(hidden, target)
            return len(items)

        def blocks():
            """(name, rows) of each block; a block may begin in one batch and end in the next."""
            name, held = None, []
            for batch in batches:
                table = pa.Table.from_batches([batch])
                ids = list(zip(table.column("_part").to_pylist(), table.column("_block").to_pylist()))
                start = 0
                for k in range(len(ids)):
                    if f"{ids[k][0]:05d}-{ids[k][1]:09d}" != name:
                        if k > start:
                            held.append(table.slice(start, k - start))
                        if held:
                            yield name, pa.concat_tables(held)
                        name, held, start = f"{ids[k][0]:05d}-{ids[k][1]:09d}", [], k
                if len(ids) > start:
                    held.append(table.slice(start))
            if held:
                yield name, pa.concat_tables(held)

        try:
            done = sum(finish(name, table) for name, table in blocks())
        finally:
            if pool:
                pool.shutdown()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["calls"])

    dealt = work.repartition("_part").sortWithinPartitions("_part", "_block", key)
    dealt.mapInArrow(commit, "calls bigint").agg(F.sum("calls")).collect()  # a number for each task
    empty = spark.createDataFrame([], result)
    return spark.read.schema(result).parquet(f"{root}/results") if not work.isEmpty() else empty


def batch_ids(df: DataFrame, group, order, size: int, out: str = "batch_id") -> DataFrame:
    """Visible fixed-size batch number ``floor((row_number-1)/size)`` within a group.

    Uses the skew-safe ranking (a group may hold a large share of the rows).
    """
    from kiln.operators.ranking import spread_row_number
    r = spread_row_number(df, group, order, "_rn")
    return r.withColumn(out, F.floor((F.col("_rn") - 1) / size).cast("bigint")).drop("_rn")
