"""Live counters of running streams."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def observed(events: DataFrame, name: str) -> DataFrame:
    """Count rows and note the latest receipt while the rows pass by; no extra job."""
    return events.observe(name, F.count(F.lit(1)).alias("rows"), F.max("timestamp_collector").alias("last_us"))


def lag(query: StreamingQuery) -> list[dict]:
    """Per source, the offsets reached and known, and rows in and processed per second."""
    progress = query.lastProgress
    if not progress:
        return []
    return [{
        "source": source["description"], "reached": source["endOffset"], "latest": source["latestOffset"],
        "in_per_s": source["inputRowsPerSecond"], "done_per_s": source["processedRowsPerSecond"],
    } for source in json.loads(progress.json)["sources"]]


def counter_stream(rows: DataFrame, name: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Count rows and note the latest receipt of every micro-batch in a table, one row for each batch.

    A batch overwrites its own folder, so one that is repeated after a failure counts once, and
    the sums hold over any number of batches and restarts; read them with :func:`counted`.
    """
    def count(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.max("timestamp_collector").alias("last_us")) \
            .write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return rows.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()


def counted(spark: SparkSession, path: str) -> DataFrame:
    """``name, rows, last_us`` over all batches of a counter stream."""
    batches = spark.read.schema("name string, rows bigint, last_us bigint").parquet(path).drop("batch")
    return batches.groupBy("name").agg(F.sum("rows").alias("rows"), F.max("last_us").alias("last_us"))


class CounterListener(StreamingQueryListener):
    """Adds up the observed counters of all queries, and notes which queries are alive.

    Register it before the queries start: it hears of every batch, however many reports a
    query keeps. ``late`` counts, by query, rows that a watermark has left out.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.last_us: dict[str, int] = {}
        self.late: dict[str, int] = {}
        self.alive: set[str] = set()

    def onQueryStarted(self, event):
        self.alive.add(str(event.id))

    def onQueryProgress(self, event):
        for name, row in event.progress.observedMetrics.items():
            self.rows[name] = self.rows.get(name, 0) + (row["rows"] or 0)
            if row["last_us"] is not None:
                self.last_us[name] = max(self.last_us.get(name, 0), row["last_us"])

        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self.late[str(event.progress.id)] = self.late.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.alive.discard(str(event.id))
