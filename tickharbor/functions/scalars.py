"""Symbol, time and path functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# A full date and time with an offset. Spark's cast alone would also take less.
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalize_symbol(symbol: ColumnOrName) -> Column:
    """Storage form of a symbol: lower case, without - _ and /."""
    return F.translate(F.lower(_col(symbol)), "-_/", "")


def ms_to_us(milliseconds: ColumnOrName) -> Column:
    """Milliseconds to microseconds; a missing or overflowing value is 0."""
    return F.coalesce(F.try_multiply(_col(milliseconds), F.lit(1000).cast("bigint")), F.lit(0).cast("bigint"))


def iso8601_to_us(text: ColumnOrName) -> Column:
    """Date-time text with an offset to microseconds; anything else is 0."""
    text = _col(text)
    stamp = F.when(text.rlike(RFC3339), F.upper(text).try_cast("timestamp"))
    return F.coalesce(F.unix_micros(stamp), F.lit(0).cast("bigint"))


def integer_text(text: ColumnOrName) -> Column:
    """Text that is an integer and nothing else, as BIGINT; otherwise NULL."""
    text = _col(text)
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def text_ms_to_us(text: ColumnOrName) -> Column:
    """Millisecond text to microseconds; a missing or malformed value is 0."""
    return ms_to_us(integer_text(text))


def numeric_sequence(sequence_id: ColumnOrName) -> Column:
    """Sequence id as a number; non-numeric ids are NULL and take no part in gap checks."""
    return integer_text(sequence_id)


def latency_us(collector: ColumnOrName = "timestamp_collector", exchange: ColumnOrName = "timestamp_exchange") -> Column:
    """Receipt minus venue time, NULL where the venue time is unknown or the clocks disagree."""
    collector, exchange = _col(collector), _col(exchange)
    return F.when((exchange > 0) & (collector > exchange), collector - exchange)


def latency_ms(collector: ColumnOrName = "timestamp_collector", exchange: ColumnOrName = "timestamp_exchange") -> Column:
    """Latency in whole milliseconds, cut off towards zero."""
    return whole(latency_us(collector, exchange), 1000)


def whole(value: ColumnOrName, divisor: int) -> Column:
    """Integer division that cuts off towards zero."""
    return F.call_function("div", _col(value), F.lit(divisor).cast("bigint"))


def utc_date(micros: ColumnOrName) -> Column:
    return F.date_format(F.timestamp_micros(_col(micros)), "yyyy-MM-dd")


def epoch_ms(micros: ColumnOrName) -> Column:
    return F.unix_millis(F.timestamp_micros(_col(micros)))


def archive_path(
    exchange: ColumnOrName,
    symbol: ColumnOrName,
    data_type: ColumnOrName,
    opened_us: ColumnOrName,
    server: ColumnOrName | None = None,
) -> Column:
    """Relative path of an archive file: venue, symbol, type, optional server, date, stamp."""
    parts = [_col(exchange), _col(symbol), _col(data_type)]
    if server is not None:
        parts.append(_col(server))
    name = F.concat(epoch_ms(opened_us).cast("string"), F.lit(".parquet"))
    return F.concat_ws("/", *parts, utc_date(opened_us), name)


def feed_name(feed: ColumnOrName) -> Column:
    """Configured feed name to its canonical form; NULL for an unknown one. Case matters."""
    feed = _col(feed)
    return F.when(feed == "orderbook", "orderbook").when(feed.isin("trades", "trade"), "trades")


def feed_data_type(feed: ColumnOrName) -> Column:
    """The stored data type of a canonical feed."""
    return F.when(_col(feed) == "trades", "trade").otherwise(_col(feed))
