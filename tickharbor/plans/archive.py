"""Queries that write the archive to the shared folder and read it back."""

from pyspark.sql import functions as F

from tickharbor.operators.parsing import market_events, parse_frames
from tickharbor.operators.quality import rows_and_files
from tickharbor.plans.catalog import add
from tickharbor.plans.frames import DUCK_EXPECTED
from tickharbor.plans.quality import duck_files
from tickharbor.session import work_folder
from tickharbor.sources import archive as A
from tickharbor.sources import plain_archive as P
from tickharbor.sources.sample_market import landed_frames

_KEYS = "exchange, symbol, data_type"
_STORED = f"""{DUCK_EXPECTED}, stored AS (SELECT exchange, symbol, kind AS data_type, sequence_id AS exchange_sequence_id, timestamp_collector,
  timestamp_exchange_us AS timestamp_exchange, data, strftime(make_timestamp(timestamp_collector), '%Y-%m-%d') AS date
  FROM expected WHERE kind IN ('orderbook', 'trade'))"""


def _archived(spark, d):
    """Root of a new archive of a test folder."""
    root = work_folder(spark, "archive")
    A.write_archive(market_events(parse_frames(landed_frames(spark, d))), root, server="srv1")
    return root


add("archive_round_trip", lambda spark, d: A.read_archive(spark, _archived(spark, d)), "SNK-1, SRT-1, SRC-2",
    f"WITH {_STORED} SELECT *, 'srv1' AS server FROM stored")

add("archive_one_day", lambda spark, d: A.read_archive(spark, _archived(spark, d))
    .where("date = '2024-01-15' AND data_type = 'trade'").groupBy("exchange", "symbol").agg(F.count("*").alias("rows")),
    "SRC-2, partition pruning", f"""WITH {_STORED} SELECT exchange, symbol, count(*) AS rows FROM stored
WHERE date = '2024-01-15' AND data_type = 'trade' GROUP BY ALL""")


def _manifest(spark, d):
    manifest = A.file_manifest(spark, _archived(spark, d))
    return manifest.groupBy("exchange", "symbol", "data_type").agg(
        F.sum("rows").alias("rows"), (F.min("size") > 0).alias("sized"), (F.count("*") > 0).alias("has_files"))


add("file_manifest", _manifest, "SNK-3, FLT-4, FN-10",
    f"WITH {_STORED} SELECT {_KEYS}, count(*) AS rows, true AS sized, true AS has_files FROM stored GROUP BY ALL")


def _compacted(spark, d):
    root, target = _archived(spark, d), work_folder(spark, "compact")
    A.compact(spark, root, target, ["2024-01-10", "2024-01-11"])
    rows = A.read_archive(spark, target).withColumn("file_path", F.col("_metadata.file_path"))
    return rows_and_files(rows)


add("compacted_days", _compacted, "SNK-6, SNK-2, AGG-4",
    f"""WITH {_STORED} SELECT {_KEYS}, count(*) AS rows, count(DISTINCT date) AS files FROM stored
WHERE date IN ('2024-01-10', '2024-01-11') GROUP BY ALL""")


def _both_roots(spark, d):
    remote, local = work_folder(spark, "remote"), work_folder(spark, "local")
    A.write_by_mode(market_events(parse_frames(landed_frames(spark, d))), "both", remote, local)
    counted = [A.read_archive(spark, root).groupBy("data_type").agg(F.count("*").alias("rows")).withColumn("root", F.lit(name))
               for name, root in (("remote", remote), ("local", local))]
    return counted[0].unionByName(counted[1])


add("storage_fan_out", _both_roots, "SNK-4", f"""WITH {_STORED}
SELECT data_type, count(*) AS rows, root FROM stored CROSS JOIN (VALUES ('remote'), ('local')) AS roots(root) GROUP BY ALL""")


# --- folders of bare values -------------------------------------------------------------------

_FILES = f"""WITH RECURSIVE {DUCK_EXPECTED}, {duck_files()},
files AS (SELECT p.exchange, p.symbol, p.data_type, o.opened_us, p.timestamp_collector
  FROM sized p ASOF JOIN opened o ON p.exchange = o.exchange AND p.symbol = o.symbol AND p.data_type = o.data_type AND p.rn >= o.rn),
dated AS (SELECT *, 'srv1' AS server, strftime(make_timestamp(opened_us), '%Y-%m-%d') AS file_date, opened_us // 1000 AS file_ts FROM files)"""


def _plain(spark, d):
    """Root of a new archive of bare-value folders."""
    root = work_folder(spark, "plain-archive")
    P.write_plain_archive(market_events(parse_frames(landed_frames(spark, d))), root, server="srv1")
    return root


def _plain_files(spark, d):
    rows = P.read_plain_archive(spark, _plain(spark, d))
    return rows.groupBy("exchange", "symbol", "data_type", "server", "file_date", "file_ts").agg(
        F.count("*").alias("rows"), F.min("timestamp_collector").alias("first_us"), F.max("timestamp_collector").alias("last_us"))


add("plain_archive_files", _plain_files, "SRC-2, SNK-1, WIN-7, FN-10, FN-11", f"""{_FILES}
SELECT {_KEYS}, server, file_date, file_ts, count(*) AS rows, min(timestamp_collector) AS first_us, max(timestamp_collector) AS last_us
FROM dated GROUP BY ALL""")


def _plain_scan(spark, d):
    rows = P.read_plain_archive(spark, _plain(spark, d), venues=["okx", "upbit"], data_types=["trade"], dates=["2024-01-10", "2024-01-15"])
    return rows.groupBy("exchange", "symbol", "file_date").agg(F.count("*").alias("rows"), F.countDistinct("file_path").alias("files"))


add("plain_archive_scan", _plain_scan, "SRC-2, partition pruning", f"""{_FILES}
SELECT exchange, symbol, file_date, count(*) AS rows, count(DISTINCT opened_us) AS files FROM dated
WHERE exchange IN ('okx', 'upbit') AND data_type = 'trade' AND file_date IN ('2024-01-10', '2024-01-15') GROUP BY ALL""")
