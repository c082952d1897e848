"""Text sources: one row per line in column ``value``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A bounded table of lines."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of the files of a folder as a stream; ``availableNow`` makes it bounded."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Unbounded lines from a socket, for trials; it cannot replay after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def lines_of(df: DataFrame, text: str) -> DataFrame:
    """One row per line of a text column."""
    return df.select(F.explode(F.split(text, "\n")).alias("value"))
