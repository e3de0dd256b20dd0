"""Sources and sinks (inventory family A)."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.joins import pending
from kiln.session import written

MSG = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MSGS = T.ArrayType(MSG)

# Reference-shaped schemas (explicit: no inference at scale).
CONSTITUTION_HAND = T.StructType([T.StructField("trait", T.StringType()),
                                  T.StructField("questions", T.ArrayType(T.StringType()))])
CONSTITUTION_FEW = T.StructType(CONSTITUTION_HAND.fields + [
    T.StructField("additional_questions", T.ArrayType(T.StringType()))])
DPO = T.StructType([T.StructField("chosen", MSGS), T.StructField("rejected", MSGS)])
SFT = T.StructType([T.StructField("messages", MSGS)])
ROBUSTNESS = T.StructType([T.StructField("question", T.StringType()), T.StructField("response", T.StringType())])


def with_position(df: DataFrame, out: str) -> DataFrame:
    """The 0-based order of rows as files hold them: by file, block and place in the block.

    Rows are counted for each (file, block), the counts are summed up in file
    order, and a row's position is its block's start plus its place in the
    block: nothing is sorted, and rows are not moved but for an equi-join with
    one row for each block, of which there are as many as scan tasks.
    """
    at = (df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_block", F.col("_metadata.file_block_start"))
          .withColumn("_row", F.monotonically_increasing_id()))
    blocks = at.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    blocks = written(blocks, "blocks")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("_file").agg(F.sum("_n").alias("_size"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = files.withColumn("_earlier", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    shift = F.col("_earlier") + F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = written(blocks.join(files, "_file").select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), shift.alias("_shift")),
                     "block-starts")
    met = at.join(starts, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return met.withColumn(out, (F.col("_row") + F.col("_shift")).cast("bigint")).drop("_file", "_block", "_row", "_f", "_b", "_shift")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str | None = "_corrupt",
               position: str | None = None) -> DataFrame:
    """A1: JSON-lines records with an explicit schema; malformed lines land in ``corrupt_col``.

    ``position`` adds the record's 0-based file order (the reference's row identity).
    """
    s = schema
    r = spark.read.schema(s)
    if corrupt_col:
        s = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
        r = spark.read.schema(s).option("columnNameOfCorruptRecord", corrupt_col).option("mode", "PERMISSIVE")
    df = r.json(path)
    return with_position(df, position) if position else df


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, position: str | None = None) -> DataFrame:
    """A2: a file holding one JSON array of records."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return with_position(df, position) if position else df


def read_columnar(spark: SparkSession, path: str) -> DataFrame:
    """A3: columnar dataset (Parquet)."""
    return spark.read.parquet(path)


def with_file_key(df: DataFrame, out: str = "key", suffix: str = ".jsonl") -> DataFrame:
    """A4: recover the ``model[-constitution]`` key from each row's file name."""
    pat = "^(.*)" + suffix.replace(".", "\\.") + "$"
    return df.withColumn(out, F.regexp_extract(F.col("_metadata.file_name"), pat, 1))


def read_results(spark: SparkSession, root: str, schema: T.StructType, suffix: str = ".jsonl",
                 out: str = "key") -> DataFrame:
    """A4: every ``*suffix`` file under ``root`` as one table keyed by file name."""
    df = spark.read.schema(schema).option("pathGlobFilter", "*" + suffix).json(root)
    return with_file_key(df, out, suffix)


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """(path, length) of every data file under ``root``, from the file index: no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*" + suffix)
            .load(root).select("path", "length"))


def _path_key(path: Column, keys: list[str], k: int, suffix: str) -> Column:
    pattern = "".join("/([^/]+)" for _ in keys[:-1]) + "/([^/]+)" + suffix.replace(".", "\\.") + "$"
    return F.regexp_extract(path, pattern, k + 1)


def list_path_keys(spark: SparkSession, root: str, keys: list[str], suffix: str = ".jsonl") -> DataFrame:
    """A4 + A9: (path, keys) of every ``*suffix`` file under ``root``; the last path components are the keys."""
    files = list_files(spark, root, suffix)
    return files.select("path", *[_path_key(F.col("path"), keys, k, suffix).alias(n) for k, n in enumerate(keys)])


def read_path_keyed(spark: SparkSession, root: str, schema: T.StructType, keys: list[str],
                    suffix: str = ".jsonl", fmt: str = "json", where: Column | None = None) -> DataFrame:
    """A4/A5 for path-as-key layouts that are not Hive-style, e.g.
    ``{root}/{model}/{method}/{variant}/{constitution}.jsonl``: the last
    ``len(keys)`` path components (file stem last) become columns.

    ``where``, a condition on the keys, picks files from the listing before
    any is opened (their paths are what the file index holds anyway); keys
    without files cost nothing.
    """
    reader = spark.read.schema(schema).format(fmt)
    if where is None:
        df = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*" + suffix).load(root)
    else:
        paths = [r["path"] for r in list_path_keys(spark, root, keys, suffix).where(where).select("path").collect()]
        df = reader.load(paths) if paths else reader.option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*" + suffix).load(root).where(F.lit(False))
    for k, name in enumerate(keys):
        # the metadata column holds the path as a URI
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        df = df.withColumn(name, _path_key(path, keys, k, suffix))
    return df


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "json",
                     **partition_values) -> DataFrame:
    """A5: one Hive-partitioned table (``model=/method=/variant=/constitution=``).

    Absent partitions simply contribute no rows; equality filters on
    partition columns are pruned at planning time.
    """
    df = spark.read.schema(schema).option("basePath", root).format(fmt).load(root)
    for k, v in partition_values.items():
        df = df.filter(F.col(k).isin(*v) if isinstance(v, (list, tuple)) else (F.col(k) == v))
    return df


def complete_groups(df: DataFrame, group, source="source", required=("reflection", "default", "leading")) -> DataFrame:
    """Keep a group only if every required source has rows (all-or-nothing)."""
    g = [group] if isinstance(group, str) else list(group)
    ok = (df.filter(F.col(source).isin(*required)).groupBy(*g)
          .agg(F.countDistinct(source).alias("_n")).filter(F.col("_n") == len(set(required))))
    return df.join(ok.select(*g), g, "left_semi")


def write_partitioned(df: DataFrame, path: str, by=("model", "constitution"), fmt: str = "json",
                      mode: str = "overwrite") -> None:
    """One folder per model/constitution (JSON lines or Parquet).

    Dynamic partition overwrite replaces only the partitions being written.
    """
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).format(fmt).save(path))


def write_columnar(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A8."""
    df.write.mode(mode).parquet(path)


def _hive_value(path: Column, key: str) -> Column:
    """The value of ``key=`` in a path, as Spark wrote it there; null where the path has none."""
    raw = F.regexp_extract(path, f"/{key}=([^/]*)/", 1)
    value = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when((raw != "") & (raw != "__HIVE_DEFAULT_PARTITION__"), value)


def existing_keys(spark: SparkSession, path: str, keys: list[str], schema: T.StructType | str | None = None,
                  fmt: str = "parquet") -> DataFrame | None:
    """Keys already written under ``path`` (None when nothing is there yet; any other error is raised).

    Keys that are partitions (``key=value`` folders) come from the listing as
    strings, and no data file is opened; others are read from the rows.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        files = list_files(spark, path)
        of_path = F.lit(True)
        for k in keys:
            of_path = of_path & F.col("path").rlike(f"/{k}=[^/]*/")
        if not files.where(~of_path).isEmpty():
            return reader.load(path).select(*keys).distinct()
        return files.select(*[_hive_value(F.col("path"), k).alias(k) for k in keys]).distinct()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def keys_to_run(spark: SparkSession, requested: DataFrame, out_path: str, keys: list[str],
                fmt: str = "parquet") -> DataFrame:
    """Requested keys minus those already produced under ``out_path``."""
    done = existing_keys(spark, out_path, keys, fmt=fmt)
    return requested if done is None else pending(requested, done, keys)


def write_once(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A9 for a one-key output: write only if nothing exists at ``path`` (``mode("ignore")``)."""
    df.write.mode("ignore").format(fmt).save(path)


def resume(requested: DataFrame, done: DataFrame, key, response="response", retry_null: bool = False) -> DataFrame:
    """A10: rows still to generate.  Failures (null responses) count as done unless ``retry_null``."""
    d = done.filter(F.col(response).isNotNull()) if retry_null else done
    return pending(requested, d, key)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_MANIFEST = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("n_rows", T.LongType())])


def write_chunk(df: DataFrame, path: str, chunk: int, fmt: str = "parquet") -> int:
    """Persist one finished chunk of a long stage as ``chunk=<n>``; returns its number of rows.

    The chunk's folder is replaced, so writing a chunk again leaves its rows
    once.  Its line in the manifest goes first and comes back, with the number
    of rows, when all of them are written: a chunk that was cut off is not in
    it (``finished_chunks``) and ``read_chunks`` passes it over.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    _delete(spark, f"{root}/_manifest/chunk={chunk}")
    seen = Observation(f"chunk-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt).save(f"{root}/chunk={chunk}")
    rows = int(seen.get["n"])
    spark.createDataFrame([(chunk, rows)], _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{root}/_manifest/chunk={chunk}")
    return rows


def finished_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, n_rows) of every chunk that was written to its end."""
    try:
        return spark.read.schema(_MANIFEST).json(f"{path.rstrip('/')}/_manifest/*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _MANIFEST)
        raise


def read_chunks(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of all finished chunks, with their ``chunk``."""
    root = path.rstrip("/")
    done = [r["chunk"] for r in finished_chunks(spark, root).select("chunk").collect()]  # a number for each folder
    if not done:
        return spark.createDataFrame([], T.StructType(schema.fields + [T.StructField("chunk", T.IntegerType())]))
    return (spark.read.schema(schema).format(fmt).option("basePath", root).load([f"{root}/chunk={c}" for c in sorted(done)]))


def write_in_order(df: DataFrame, path: str, by=("model", "constitution"), order=("shuffle_key",), fmt: str = "json",
                   files: int | None = None, drop_order: bool = True) -> None:
    """A7 + F2: one folder per key with its rows in ``order``: files by name, lines by place.

    Rows are split by sampled ranges of (key, order), so a folder with most of
    the rows is written by as many tasks as its share, each a contiguous run,
    and small folders share one.  ``files`` sets the number of ranges; by
    default the session's shuffle partitions decide.
    """
    cols = [F.col(c) for c in (*by, *order)]
    ranged = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    ranged = ranged.sortWithinPartitions(*cols)
    if drop_order:
        ranged = ranged.drop(*order)
    (ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(fmt).save(path))
