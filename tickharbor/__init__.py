"""Market-event analytics expressed as Spark DataFrame, SQL and Structured Streaming jobs."""

from tickharbor.session import build_session, configure, durable

__all__ = ["build_session", "configure", "durable"]
