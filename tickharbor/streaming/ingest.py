"""From landed frames to the archive, continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickharbor.operators.parsing import dead_letters, market_events, parse_frames
from tickharbor.sources.archive import PARTITIONS, archive_rows, write_by_mode
from tickharbor.streaming.progress import observed


def _start(writer, trigger: dict | None) -> StreamingQuery:
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def archive_stream(frames: DataFrame, root: str, checkpoint: str, server: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Parse and append to the archive with the transactional file sink.

    The sink sorts within the tasks that read the frames: nothing is shuffled, so no key
    can be hot.
    The sink never drops rows, however late they are.
    """
    rows = archive_rows(observed(market_events(parse_frames(frames)), "archived"), server)
    writer = rows.writeStream.format("parquet").partitionBy(*PARTITIONS).option("compression", "zstd") \
        .option("path", root).option("checkpointLocation", checkpoint).outputMode("append")
    return _start(writer, trigger)


def dead_letter_stream(frames: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Frames that do not parse, with the reason, to a table of their own."""
    rows = dead_letters(parse_frames(frames)).select("exchange", "native_symbol", "feed", "timestamp_collector", "frame", "error")
    writer = rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return _start(writer, trigger)


def fan_out_stream(
    frames: DataFrame, mode: str, remote_root: str, local_root: str, checkpoint: str,
    server: str | None = None, trigger: dict | None = None, tasks: int | None = None,
) -> StreamingQuery:
    """Write each micro-batch to the roots that ``mode`` names.

    A batch has a folder of its own that it overwrites, so a batch that is repeated after
    a failure replaces what it wrote before.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_by_mode(batch, mode, f"{remote_root}/batch={batch_id}", f"{local_root}/batch={batch_id}", server, write_mode="overwrite", tasks=tasks)

    writer = market_events(parse_frames(frames)).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, trigger)


def streams_per_feed(frames: DataFrame, root: str, checkpoint: str, feeds: tuple[str, ...] = ("orderbook", "trades"), **kwargs) -> dict[str, StreamingQuery]:
    """One archive query per feed with a checkpoint and root of its own, so that one can fail and restart alone."""
    return {
        feed: archive_stream(frames.where(frames["feed"] == feed), f"{root}/{feed}", f"{checkpoint}/{feed}", **kwargs)
        for feed in feeds
    }


class Unfinished(RuntimeError):
    """Streams were stopped before they had taken in what had landed."""


def drain(queries: list[StreamingQuery], seconds: int | None = None) -> None:
    """Wait until queries have finished what has landed, then stop them.

    Without a limit of ``seconds`` it waits as long as that takes. With one it raises if a
    query has not finished in time: what that has written so far must not be read as a
    result. A stopped query goes on from its checkpoint when it is started again.
    """
    unfinished = []
    for query in queries:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            unfinished.append(str(query.id))
        query.stop()
    if unfinished:
        raise Unfinished(f"stopped after {seconds} s: {', '.join(unfinished)}")
