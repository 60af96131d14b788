"""Raw frames to parsed rows and to the uniform market-event table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickharbor.functions.documents import Document, enclose, is_one_value
from tickharbor.functions.scalars import normalize_symbol
from tickharbor.schemas import MARKET_EVENT
from tickharbor.venues import ERROR, ORDERBOOK, OTHER, TRADE, VENUES, Rule

PARSED_COLUMNS = [
    "kind", "msg_symbol", "sequence_id", "timestamp_exchange_us", "data", "error", "notice_code", "notice_msg",
]

_INVALID, _UNKNOWN_VENUE, _PLAIN, _NO_RULE = "invalid", "unknown venue", "plain text", "no rule"


def _cases(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    if not branches:
        return otherwise
    chain = F.when(*branches[0])
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


@dataclass(frozen=True)
class _RuleColumns:
    """The columns that pick a rule and read its fields; none depends on a particular table."""

    chosen: Column
    kind: Column
    error: Column
    fields: dict[str, Column]


@lru_cache(maxsize=32)
def _rule_columns(names: tuple[str, ...], application: str) -> _RuleColumns:
    """Build the columns once per application; they are a few thousand nodes."""
    exchange = F.lower(F.col("exchange"))
    document = F.col("__document")
    rules: dict[str, list[Rule]] = {name: VENUES[name].rules(Document(document)) for name in names}

    plain = [
        (exchange.eqNullSafe(name) & (F.col("frame") == text), F.lit(f"{_PLAIN}/{kind}"))
        for name in names
        for text, kind in VENUES[name].plain_text.items()
    ]
    by_venue = [
        (exchange == name, _cases([(rule.when, F.lit(f"{name}/{rule.name}")) for rule in rules[name]], F.lit(_NO_RULE)))
        for name in names
    ]
    known = F.coalesce(exchange.isin(*names), F.lit(False))
    chosen = _cases(
        [(~known, F.lit(_UNKNOWN_VENUE)), *plain, (~is_one_value(document, F.col("frame")), F.lit(_INVALID))],
        _cases(by_venue, F.lit(_UNKNOWN_VENUE)),
    )

    rule_name = F.col("__rule")
    flat = [(f"{name}/{rule.name}", rule) for name in names for rule in rules[name]]

    def pick(field: str) -> Column:
        branches = [(rule_name == key, getattr(rule, field)) for key, rule in flat if getattr(rule, field) is not None]
        return _cases(branches, F.lit(None))

    kind = _cases(
        [(rule_name == key, F.lit(rule.kind)) for key, rule in flat if rule.kind != OTHER]
        + [(rule_name.isin(_INVALID, _UNKNOWN_VENUE), F.lit(ERROR))]
        + [(rule_name.startswith(_PLAIN), F.substring_index(rule_name, "/", -1))],
        F.lit(OTHER),
    )
    error = _cases(
        [(rule_name == _INVALID, F.lit("invalid JSON")),
         (rule_name == _UNKNOWN_VENUE, F.concat(F.lit("unknown exchange: "), F.coalesce(F.col("exchange"), F.lit("NULL"))))],
        pick("error"),
    )
    return _RuleColumns(chosen, kind, error, {
        "msg_symbol": pick("symbol").cast("string"),
        "sequence_id": pick("sequence").cast("string"),
        "timestamp_exchange_us": pick("time_us").cast("bigint"),
        "notice_code": pick("notice_code").cast("string"),
        "notice_msg": pick("notice_message").cast("string"),
    })


def parse_frames(frames: DataFrame, venues: list[str] | None = None) -> DataFrame:
    """Classify every frame and read its symbol, sequence id and venue time.

    The input columns stay, the venue in lower case; ``PARSED_COLUMNS`` and the normalised ``symbol`` are added. A frame that does not parse,
    or that comes from an unknown venue, becomes a row of kind ``error``; it never
    fails the job. Three projections: parse once, pick the rule, read that rule's
    fields. The VARIANT is used several times in each step, so Catalyst keeps it in
    a column of its own instead of parsing again. The rule comes out of a generator
    because a filter on ``kind`` would otherwise be pushed below the projections and
    parse every frame a second time.
    """
    application = frames.sparkSession.sparkContext.applicationId
    columns = _rule_columns(tuple(venues or VENUES), application)
    documents = frames.withColumn("__document", enclose(F.col("frame"))).withColumn("__chosen", columns.chosen)
    ruled = documents.select("*", F.explode(F.array("__chosen")).alias("__rule"))
    return ruled.select(
        *[F.lower(name).alias(name) if name == "exchange" else F.col(name) for name in frames.columns],
        columns.kind.alias("kind"),
        columns.error.cast("string").alias("error"),
        *[column.alias(name) for name, column in columns.fields.items()],
    ).withColumns({
        "data": F.when(F.col("kind").isin(ORDERBOOK, TRADE, OTHER), F.col("frame")),
        "symbol": normalize_symbol("native_symbol"),
    })


def parse_venue(frames: DataFrame, name: str) -> DataFrame:
    """Frames of one venue only, parsed with that venue's rules."""
    return parse_frames(frames.where(F.lower("exchange") == name), [name])


def data_rows(parsed: DataFrame) -> DataFrame:
    """Only order-book and trade rows; replies, heartbeats, pongs and errors carry no data."""
    return parsed.where(F.col("kind").isin(ORDERBOOK, TRADE))


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Frames that could not be parsed, with the reason."""
    return parsed.where(F.col("kind") == ERROR)


def market_events(parsed: DataFrame, *keep: str) -> DataFrame:
    """Parsed rows to the stored form.

    The symbol in the message is dropped: the stored symbol is the subscribed one,
    normalised. One row per frame, whatever number of fills or levels it holds.
    ``keep`` names further input columns to carry along.
    """
    columns = [
        F.col("exchange"),
        F.col("symbol"),
        F.col("kind").alias("data_type"),
        F.col("sequence_id").alias("exchange_sequence_id"),
        F.col("timestamp_collector"),
        F.col("timestamp_exchange_us").alias("timestamp_exchange"),
        F.col("data"),
    ]
    assert len(columns) == len(MARKET_EVENT)
    return data_rows(parsed).select(*columns, *keep)
