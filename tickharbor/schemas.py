"""Table schemas. Times are BIGINT microseconds since the epoch; 0 is an unknown venue time."""

from pyspark.sql import types as T


def _struct(*columns: tuple[str, T.DataType], nullable: bool = True) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind in columns])


RAW_FRAME = _struct(
    ("exchange", T.StringType()),
    ("native_symbol", T.StringType()),
    ("feed", T.StringType()),
    ("timestamp_collector", T.LongType()),
    ("frame", T.StringType()),
)

# Columns of an archive file. The data type is only in the path.
ARCHIVE_FILE = _struct(
    ("exchange", T.StringType()),
    ("symbol", T.StringType()),
    ("exchange_sequence_id", T.StringType()),
    ("timestamp_collector", T.LongType()),
    ("timestamp_exchange", T.LongType()),
    ("data", T.StringType()),
    nullable=False,
)

MARKET_EVENT = _struct(
    ("exchange", T.StringType()),
    ("symbol", T.StringType()),
    ("data_type", T.StringType()),
    ("exchange_sequence_id", T.StringType()),
    ("timestamp_collector", T.LongType()),
    ("timestamp_exchange", T.LongType()),
    ("data", T.StringType()),
)

MARKET_CONFIG = _struct(
    ("exchange", T.StringType()),
    ("symbols", T.ArrayType(T.StringType())),
    ("feeds", T.ArrayType(T.StringType())),
    ("base_url", T.StringType()),
    ("data_timeout_secs", T.LongType()),
)

# The key an archive file belongs to, and the key a connection belongs to.
WRITER_KEY = ["exchange", "symbol", "data_type"]
STREAM_KEY = ["exchange", "symbol", "feed"]
