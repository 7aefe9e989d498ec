"""File sources: uploaded CSV with line numbers, JSON rows and file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Uploaded CSV with a header as text columns; lines that do not fit keep their text in ``_corrupt``."""
    schema = ", ".join(f"`{c}` STRING" for c in [*columns, CORRUPT])
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def with_line_numbers(df: DataFrame, out: str = "row_no", first: int = 2) -> DataFrame:
    """Number the rows in read order without gathering them.

    The generated id carries the partition and the place inside it; adding the
    row counts of the earlier partitions makes it dense. The window runs over one
    row per input partition.
    """
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    marked = marked.withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return marked.join(starts, "_part").withColumn(out, F.col("_start") + F.col("_at") + first).drop("_id", "_part", "_at", "_start")


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a file stream. In production the same jobs read a Kafka topic.

    ``path`` may be a table folder or a single file inside a folder of tables.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def stream_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Raw JSON text of a Kafka topic; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.col("value").cast("string").alias("body"), F.col("timestamp").alias("received_at"))
