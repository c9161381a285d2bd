"""File sources: bronze batches, event lines, landing loads, discovery and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.schemas import CANONICAL, MONEY, MONEY_COLUMNS

# ---- Fixed values: file naming and named formats -----------------------------------------------
FILE_NAME = r"([a-z_]+)_(\d{8}T\d{6}Z)\.(csv|json)$"
FILE_FORMATS = {
    "json": {"format": "json", "options": {"multiLine": "true"}},
    "jsonl": {"format": "json", "options": {}},
    "csv": {"format": "csv", "options": {"header": "true", "quote": '"', "escape": '"'}},
    "parquet": {"format": "parquet", "options": {}},
}
NULL_TOKENS = ["NULL", "null", ""]
DEALT_BYTES = 4 << 20  # a core's share of a table below which its rows are dealt out
LISTING_TASKS = 2  # tasks a core that look up files read by name
# Format of each bronze dataset; all arrive as JSON lists today.
SOURCE_FORMATS = {dataset: "json" for dataset in CANONICAL}


def read_files(
    spark: SparkSession, name: str, paths: list[str], schema: T.StructType
) -> DataFrame:
    """Read many files by their names. Spark looks each up again, by default in a task of its own; here
    the tasks that do so share the names, however many there are."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism))
    try:
        return read_format(spark, name, paths, schema)
    finally:
        spark.conf.set(key, before)


def read_format(
    spark: SparkSession, name: str, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Read with a named format. CSV null tokens become null in every text column."""
    preset = FILE_FORMATS[name]
    reader = spark.read.format(preset["format"]).options(**preset["options"])
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    if name != "csv":
        return df
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in text}
    ) if text else df


def read_bronze(
    spark: SparkSession, root: str, dataset: str, source_format: str | None = None
) -> DataFrame:
    """All bronze files of a dataset, ``<root>/<dataset>/<dataset>_*``, with its canonical schema.

    A JSON list is one unsplittable file, so producers must roll files; parallelism is the number
    of files. Nothing is inferred, so the data is read once.
    """
    kind = source_format or SOURCE_FORMATS[dataset]
    suffix = "csv" if kind == "csv" else "json"
    return read_format(spark, kind, f"{root}/{dataset}/{dataset}_*.{suffix}", CANONICAL[dataset])


def read_event_lines(
    spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False, **options
) -> DataFrame:
    """JSON-lines events with the name of the file each row came from."""
    reader = spark.readStream if streaming else spark.read
    df = reader.schema(schema).options(**options).json(path)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def load_landing(
    df: DataFrame,
    dataset: str,
    load_id: str,
    loaded_at: Column | None = None,
    on_error: str = "abort",
) -> DataFrame:
    """Semi-structured rows to typed landing columns plus load id and time.

    ``abort`` uses ANSI casts, so one bad value fails the load; ``null`` keeps the row with a null.
    """
    if on_error not in ("abort", "null"):
        raise ValueError("on_error must be 'abort' or 'null'")

    def typed(name: str, kind: str) -> Column:
        c = F.col(name) if name in df.columns else F.lit(None)
        if on_error == "null":
            return c.try_cast(kind).alias(name)
        # assert_true keeps the abort independent of the session's ANSI switch.
        value = c.try_cast(kind)
        bad = c.isNotNull() & value.isNull()
        message = F.concat(F.lit(f"cannot load {name} as {kind}: "), c.cast("string"))
        return F.when(bad, F.raise_error(message)).otherwise(value).alias(name)

    amounts = set(MONEY_COLUMNS.get(dataset, []))
    columns = []
    for f in CANONICAL[dataset].fields:
        if f.name in amounts:
            kind = MONEY
        elif isinstance(f.dataType, T.TimestampType):
            kind = "timestamp_ntz"
        else:
            kind = f.dataType.simpleString()
        columns.append(typed(f.name, kind))
    columns += [
        typed("ingestion_timestamp", "timestamp_ntz"),
        typed("source_file", "string"),
        typed("processing_date", "date"),
        F.lit(load_id).alias("load_id"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("load_timestamp"),
    ]
    return df.select(columns)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and change time of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified_at"))
    )


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files at or below a path; the file system adds them up."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def dealt(df: DataFrame, path: str) -> DataFrame:
    """The rows of a table read from ``path``, dealt to all cores if it is small: a reader cuts a file
    between row groups only, so one task may get all rows of a small file. Large ones stay as read."""
    n = cores(df.sparkSession)
    return df.repartition(n) if bytes_of(df.sparkSession, path) < n * DEALT_BYTES else df


def match_batch_files(files: DataFrame, latest_only: bool = False) -> DataFrame:
    """Of a file listing (path, length), those named ``<dataset>_<timestamp>.<csv|json>`` for one of
    the seven datasets.

    ``latest_only`` keeps the file with the greatest embedded timestamp per dataset (a max per
    dataset, not a sort of all files).
    """
    named = (
        files.withColumn("filename", F.element_at(F.split("path", "/"), -1))
        .filter(F.col("filename").rlike("^" + FILE_NAME))
        .select(
            F.regexp_extract("filename", FILE_NAME, 1).alias("dataset_name"),
            F.regexp_extract("filename", FILE_NAME, 2).alias("file_timestamp"),
            F.regexp_extract("filename", FILE_NAME, 3).alias("source_format"),
            "filename",
            "path",
            "length",
        )
        .filter(F.col("dataset_name").isin(list(CANONICAL)))
    )
    if not latest_only:
        return named
    row = F.struct("file_timestamp", "filename", "source_format", "path", "length")
    return named.groupBy("dataset_name").agg(F.max(row).alias("_f")).select("dataset_name", "_f.*")


def discover_batch_files(spark: SparkSession, root: str, latest_only: bool = False) -> DataFrame:
    return match_batch_files(list_files(spark, root), latest_only)


def latest_dataset_file(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return discover_batch_files(spark, f"{root}/{dataset}", latest_only=True).filter(
        F.col("dataset_name") == dataset
    )


def ingestion_manifest(
    spark: SparkSession,
    root: str,
    dataset: str,
    ingested_at: Column | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Per file: format, row count, SHA-256 and ingestion id; status tells why a file is refused.

    Checksums and counts are two distributed passes that meet on the file path.
    """
    at = ingested_at if ingested_at is not None else F.current_timestamp()
    fmt = SOURCE_FORMATS[dataset]
    names = F.col("_metadata.file_path")
    sums = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(f"{root}/{dataset}")
        .select(names.alias("_path"), F.sha2("content", 256).alias("source_checksum"))
    )
    pattern = f"{root}/{dataset}" if recursive else f"{root}/{dataset}/*.{fmt}"
    preset = FILE_FORMATS[fmt]
    counts = (
        spark.read.format(preset["format"])
        .options(**preset["options"], recursiveFileLookup=str(recursive).lower())
        .schema(CANONICAL[dataset])
        .load(pattern)
        .groupBy(names.alias("_path"))
        .agg(F.count("*").alias("source_row_count"))
    )
    filename = F.element_at(F.split("_path", "/"), -1)
    named = (F.regexp_extract("filename", "^" + FILE_NAME, 1) == dataset)
    rows = F.coalesce(F.col("source_row_count"), F.lit(0))
    return (
        sums.join(counts, "_path", "left")
        .withColumn("filename", filename)
        .select(
            F.lit(dataset).alias("dataset_name"),
            "filename",
            F.col("_path").alias("source_path"),
            F.lit(fmt).alias("source_format"),
            rows.alias("source_row_count"),
            "source_checksum",
            F.concat_ws("-", F.lit(dataset), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")).alias(
                "ingestion_id"
            ),
            at.alias("ingestion_timestamp"),
            F.when(~named, "bad_name").when(rows == 0, "empty").otherwise("accepted").alias("status"),
        )
    )


def load_seed(spark: SparkSession, values: list, column: str, kind: str = "string") -> DataFrame:
    """A small reference list given with the code (currency codes, for one), as a table."""
    return spark.createDataFrame([(v,) for v in values], f"`{column}` {kind}").distinct()


def keep_seeded(df: DataFrame, seed: DataFrame, column: str) -> DataFrame:
    """Rows whose value is in the seed table. Spark broadcasts the seed by its size."""
    return df.join(seed, column, "left_semi")


def read_listings(spark: SparkSession, path: str, symbols: list[str] | None = None) -> DataFrame:
    """Securities listing with a header row, optionally only some symbols."""
    listing = "symbol string, name string, exchange string, assetType string, ipoDate string, " \
        "delistingDate string, status string"
    df = spark.read.schema(listing).option("header", "true").csv(path)
    if symbols is None:
        return df
    return df.filter(F.upper(F.trim("symbol")).isin([s.strip().upper() for s in symbols]))
