"""Read-only sources, named by a path (with a format) or a catalogue table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

FORMATS = ("parquet", "orc", "csv", "json", "avro")


def read_source(spark: SparkSession, ref: str, schema: StructType | None = None,
                **options: str) -> DataFrame:
    """`table:<name>`, `<format>:<path>`, or a bare Parquet path."""
    kind, _, rest = ref.partition(":")
    if kind == "table":
        return spark.table(rest)
    fmt, path = (kind, rest) if kind in FORMATS else ("parquet", ref)
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_files(spark: SparkSession, ref: str, files: list[str], schema: StructType) -> DataFrame:
    """Some files of a source, with the columns of the whole."""
    kind = ref.partition(":")[0]
    return (spark.read.format(kind if kind in FORMATS else "parquet").schema(schema)
            .option("basePath", source_path(ref)).load(files))


def source_path(ref: str) -> str | None:
    """The path behind a source, or None for a catalogue table."""
    kind, _, rest = ref.partition(":")
    if kind == "table":
        return None
    return rest if kind in FORMATS else ref


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modified for every file; only the listing is read, no content.

    Spark plans tasks by file size. No file is opened here, so the frame lives
    in a session where size does not count and the tasks are one per core.
    """
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionBytes", str(2**60))
    return (lister.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def listing_mark(spark: SparkSession, path: str) -> str:
    """One text that changes whenever a file is added, removed or rewritten."""
    row = (file_listing(spark, path)
           .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"),
                F.max(F.unix_micros("modified")).alias("newest"),
                F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modified")))
                .alias("mark"))
           .first())
    return f"{row.files}|{row.bytes}|{row.newest}|{row.mark}"


def record_listing(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Write the listing to `out` and read it back, so that it can be compared later."""
    file_listing(spark, path).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def added_files(before: DataFrame, after: DataFrame) -> list[str] | None:
    """Files that one listing has more than another; None when any file left or changed.

    The driver holds the names of files that landed in between, and no more.
    """
    file = ["path", "length", "modified"]
    if before.join(after, file, "left_anti").limit(1).count():
        return None
    return [r.path for r in after.join(before, file, "left_anti").select("path").collect()]


def newest_in(mark: str | None) -> int | None:
    """The newest modification time a listing mark was made from, in microseconds: the same in every zone."""
    newest = mark.split("|")[2] if mark else ""
    return int(newest) if newest.isdigit() else None


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at `path`, or an empty frame while nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
