"""Command line: ``sync`` a database from change envelopes, or run a SQL ``script``."""

from __future__ import annotations

import argparse
import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.options import SinkOptions


def pairs(texts: Sequence[str] | None) -> dict[str, str] | None:
    """``key=value`` texts as a map. Only a password may be empty; one bad text voids the map."""
    out = {}
    for text in texts or []:
        key, eq, value = text.partition("=")
        if not eq or (not value.strip() and key.strip() != "password"):
            return None
        out[key.strip()] = value.strip()
    return out


def sink_options(texts: Sequence[str] | None) -> SinkOptions:
    """Load options of a synchronised database: JSON rows and exactly once unless the texts say otherwise."""
    own = {k if k.startswith("sink.") else f"sink.{k}": v for k, v in (pairs(texts) or {}).items()}
    return SinkOptions.parse({"sink.semantic": "exactly-once", "sink.properties.format": "json", **own})


def statements(script: str) -> list[str]:
    """SQL statements, each ended by a semicolon at the end of a line."""
    return [s.strip().rstrip(";").strip() for s in re.split(r";\s*\n", script + "\n") if s.strip().rstrip(";").strip()]


def run_script(spark: SparkSession, script: str) -> list[DataFrame]:
    return [spark.sql(s) for s in statements(script)]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("sync", help="change envelopes (JSON lines) into the tables of a store")
    s.add_argument("--job-name", default="sync")
    s.add_argument("--database", required=True)
    s.add_argument("--source", required=True, help="folder of JSON lines files")
    s.add_argument("--schema", required=True, help="JSON file: list of {database, name, keys, columns}")
    s.add_argument("--store", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--table-prefix", default="")
    s.add_argument("--table-suffix", default="")
    s.add_argument("--including-tables")
    s.add_argument("--excluding-tables")
    s.add_argument("--startup", default="initial", choices=("initial", "earliest-offset", "latest-offset", "timestamp"))
    s.add_argument("--startup-timestamp-ms", type=int)
    for name in ("source-conf", "sink-conf", "table-conf"):
        s.add_argument(f"--{name}", action="append")
    q = sub.add_parser("script", help="run a SQL file")
    q.add_argument("-f", "--file", required=True)
    return p


def envelope_stream(spark: SparkSession, folder: str, startup: str = "initial", timestamp_ms: int | None = None, conf: dict | None = None) -> DataFrame:
    """A stream of envelopes. ``latest-offset`` skips files that are there, ``timestamp`` skips older records."""
    reader = spark.readStream.format("text").options(**(conf or {}))
    if startup == "latest-offset":
        reader = reader.option("ignoreMissingFiles", "true").option("maxFileAge", "1ms")
    stream = reader.load(folder)
    if startup == "timestamp":
        stream = stream.where(f"cast(get_json_object(value, '$.ts_ms') as long) >= {int(timestamp_ms or 0)}")
    return stream


def main(argv: Sequence[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(getattr(a, "job_name", "script")).getOrCreate()
    if a.command == "script":
        with open(a.file, encoding="utf-8") as f:
            for df in run_script(spark, f.read()):
                df.show(truncate=False)
        return
    from millrace.streaming.cdc_sync import DatabaseSync, SourceColumn, SourceTable
    from millrace.streaming.commit import CommitLog
    from millrace.streaming.sink import reader_limits

    with open(a.schema, encoding="utf-8") as f:
        found = [SourceTable(t["database"], t["name"], tuple(SourceColumn(**c) for c in t["columns"]), tuple(t["keys"])) for t in json.load(f)]
    sync = DatabaseSync(
        spark, CommitLog(spark, a.store), a.database, a.table_prefix, a.table_suffix, a.including_tables, a.excluding_tables,
        options=sink_options(a.sink_conf), table_options=pairs(a.table_conf) or {},
    )
    sync.discover(found)
    limits = reader_limits(sync.options) | (pairs(a.source_conf) or {})
    stream = envelope_stream(spark, a.source, a.startup, a.startup_timestamp_ms, limits)
    sync.start(stream, a.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
