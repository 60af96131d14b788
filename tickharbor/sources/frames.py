"""Landed raw frames, as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.schemas import RAW_FRAME
from tickharbor.session import configure


def read_frames(spark: SparkSession, path: str, stream: bool = False, form: str = "json", **options) -> DataFrame:
    """Frames from JSON or Parquet files with a fixed schema. As a stream, new files are picked up as they land.

    ``maxFilesPerTrigger`` bounds a micro-batch; nothing is dropped under pressure, the
    stream only falls behind, and :func:`tickharbor.streaming.progress.lag` reports by how much.
    """
    reader = configure(spark).readStream if stream else configure(spark).read
    return reader.schema(RAW_FRAME).options(**options).format(form).load(path)


def read_kafka_frames(spark: SparkSession, servers: str, topic: str, stream: bool = True, **options) -> DataFrame:
    """Frames from a Kafka topic whose values are JSON rows of the frame schema; needs Spark's Kafka package."""
    reader = configure(spark).readStream if stream else configure(spark).read
    raw = reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).options(**options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), RAW_FRAME).alias("row")).select("row.*")


def sample_frames(frames: DataFrame, fraction: float = 0.001) -> DataFrame:
    """A share of the frames, for looking at them, chosen by a hash of the frame: the same frames every time.

    Copies of a frame are all in the sample or all out of it; a frame that is null is out.
    """
    share = F.conv(F.substring(F.md5("frame"), 1, 8), 16, 10).cast("bigint")
    return frames.where(share < int(fraction * 2**32))
