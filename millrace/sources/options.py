"""Options of scans, loads and catalogs that mean something on Spark, validated where they are made."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

from millrace.functions.text import parse_delimiter

MB = 1 << 20
GB = 1 << 30


def with_prefix(options: Mapping[str, str], prefix: str) -> dict[str, str]:
    """The options below a prefix, without it."""
    return {k[len(prefix) :]: v for k, v in options.items() if k.startswith(prefix)}


@dataclass(frozen=True)
class ScanOptions:
    columns: str = ""
    filter: str = ""
    limit: int | None = None
    batch_rows: int = 1_000
    max_retries: int = 1
    lookup_ttl_ms: int = 5_000
    lookup_max_rows: int = -1
    properties: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.batch_rows <= 0 or self.max_retries < 0 or (self.limit is not None and self.limit < 0):
            raise ValueError("batch rows are positive; retries and limit are not negative")

    @classmethod
    def parse(cls, options: Mapping[str, str]) -> ScanOptions:
        names = {
            "scan.columns": "columns", "scan.filter": "filter", "scan.limit": "limit",
            "scan.params.batch-rows": "batch_rows", "scan.max-retries": "max_retries",
            "lookup.cache.ttl-ms": "lookup_ttl_ms", "lookup.cache.max-rows": "lookup_max_rows",
        }
        got = {a: options[o] if a in ("columns", "filter") else int(options[o]) for o, a in names.items() if o in options}
        rest = {k: v for k, v in with_prefix(options, "scan.params.").items() if f"scan.params.{k}" not in names}
        return cls(**got, properties=rest)

    def copy(self, **changes) -> ScanOptions:
        return replace(self, **changes)


def all_or_none(options: Mapping[str, str], required: tuple[str, ...]) -> bool:
    """Whether the required options are there. Some without the others is an error."""
    there = [k for k in required if options.get(k)]
    if there and len(there) < len(required):
        raise ValueError(f"missing options: {sorted(set(required) - set(there))}")
    return bool(there)


@dataclass(frozen=True)
class SinkOptions:
    semantic: str = "at-least-once"
    label_prefix: str | None = None
    flush_max_bytes: int = 90 * MB
    flush_max_rows: int = 500_000
    flush_interval_ms: int = 300_000
    enqueue_timeout_ms: int = 600_000
    max_retries: int = 3
    chunk_limit: int = 3 * GB
    ignore_update_before: bool = True
    multi_table: bool = False
    multi_table_buffer: int = 128 * MB
    merge_commit: bool = False
    blackhole: bool = False
    sanitize_error_log: bool = False
    parallelism: int | None = None
    abort_lingering: bool = True
    check_lingering: int = -1
    format: str = "csv"
    column_separator: str = "\t"
    row_delimiter: str = "\n"
    strip_outer_array: bool = True
    columns: str | None = None
    partial_update: bool = False
    merge_condition: str | None = None
    max_filter_ratio: float = 0.0
    strict_mode: bool = False
    compression: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        def ranged(name: str, low: float, high: float) -> None:
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} is between {low} and {high}")

        if self.semantic not in ("at-least-once", "exactly-once"):
            raise ValueError("semantic is at-least-once or exactly-once")
        if self.format not in ("csv", "json"):
            raise ValueError("format is csv or json")
        ranged("max_retries", 0, 1_000)
        ranged("flush_interval_ms", 1, 3_600_000)
        ranged("flush_max_rows", 64_000, 5_000_000)
        ranged("flush_max_bytes", 64 * MB, 10 * GB)
        ranged("enqueue_timeout_ms", 300_000, float("inf"))
        ranged("max_filter_ratio", 0.0, 1.0)
        if self.multi_table and (self.semantic == "exactly-once" or self.merge_commit):
            raise ValueError("transactions over several tables are at-least-once and exclude merge commit")
        if self.compression not in (None, "lz4_frame", "lz4", "zstd", "snappy"):
            raise ValueError(f"unsupported compression {self.compression}")

    @property
    def effective_chunk(self) -> int:
        return min(self.chunk_limit, 3 * GB if self.format == "json" else 10 * GB)

    @classmethod
    def parse(cls, options: Mapping[str, str]) -> SinkOptions:
        """From option texts: ``sink.*`` with dashes and dots for underscores, and ``sink.properties.*``."""
        kinds = {f.name: f.type for f in fields(cls)}
        names = {
            "sink.semantic": "semantic", "sink.label-prefix": "label_prefix", "sink.max-retries": "max_retries",
            "sink.buffer-flush.max-bytes": "flush_max_bytes", "sink.buffer-flush.max-rows": "flush_max_rows",
            "sink.buffer-flush.interval-ms": "flush_interval_ms", "sink.chunk-limit": "chunk_limit",
            "sink.buffer-flush.enqueue-timeout-ms": "enqueue_timeout_ms", "sink.parallelism": "parallelism",
            "sink.ignore.update-before": "ignore_update_before", "sink.blackhole": "blackhole",
            "sink.transaction.multi-table.enabled": "multi_table", "sink.sanitize-error-log": "sanitize_error_log",
            "sink.transaction.multi-table.buffer-size": "multi_table_buffer",
            "sink.exactly-once.enable-abort-lingering-txn": "abort_lingering",
            "sink.exactly-once.check-num-lingering-txn": "check_lingering",
        }
        props = {k.lower(): v for k, v in with_prefix(options, "sink.properties.").items()}
        own = {
            "format": "format", "columns": "columns", "partial_update": "partial_update", "compression": "compression",
            "merge_condition": "merge_condition", "max_filter_ratio": "max_filter_ratio", "strict_mode": "strict_mode",
            "strip_outer_array": "strip_outer_array", "enable_merge_commit": "merge_commit",
        }
        raw = {a: options[o] for o, a in names.items() if o in options} | {a: props.pop(p) for p, a in own.items() if p in props}
        raw |= {a: parse_delimiter(props.pop(a)) for a in ("column_separator", "row_delimiter") if a in props}
        got = {}
        for name, text in raw.items():
            kind = kinds[name]
            if kind == "bool":
                got[name] = str(text).lower() == "true"
            elif kind in ("int", "int | None"):
                got[name] = _number(text)
            else:
                got[name] = float(text) if kind == "float" else text
        return cls(**got, properties=props)


def _number(text: str) -> int:
    m = re.fullmatch(r"\s*(\d+|-\d+)\s*([kmg]?)b?\s*", str(text), re.I)
    if not m:
        raise ValueError(f"not a number or size: {text}")
    return int(m[1]) * {"": 1, "k": 1 << 10, "m": MB, "g": GB}[m[2].lower()]


@dataclass(frozen=True)
class CatalogOptions:
    default_database: str = "default"
    buckets: int | None = None
    scan: Mapping[str, str] = field(default_factory=dict)
    sink: Mapping[str, str] = field(default_factory=dict)
    table: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, options: Mapping[str, str]) -> CatalogOptions:
        """One flat map fans out to scans, loads and new tables by prefix."""
        return cls(
            options.get("default-database", "default"),
            int(options["table.num-buckets"]) if "table.num-buckets" in options else None,
            {k: v for k, v in options.items() if k.startswith(("scan.", "lookup."))},
            {k: v for k, v in options.items() if k.startswith("sink.")},
            with_prefix(options, "table.properties."),
        )

    def sink_for(self, database: str, table: str) -> SinkOptions:
        """Load options of one table: its label prefix names it."""
        own = dict(self.sink)
        if own.get("sink.label-prefix"):
            own["sink.label-prefix"] += f"_{database}_{table}"
        return SinkOptions.parse(own)
