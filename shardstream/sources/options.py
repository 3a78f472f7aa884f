"""Source settings: an override wins over the configuration, which wins over the default."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import datetime

from shardstream.model import AT_TIMESTAMP, LATEST, TRIM_HORIZON

POSITIONS = (TRIM_HORIZON, LATEST, AT_TIMESTAMP)

# Configuration key per setting. Keys that tune leases, threads, the service client or
# its metrics have no counterpart on Spark and are passed over.
KEYS = {
    "initial_position": "initial-position-in-stream",
    "max_records": "max-records",
    "max_records_count": "max-records-count",
    "max_cache_byte_size": "max-cache-byte-size",
    "idle_time_between_reads_ms": "idle-time-between-reads",
    "idle_millis_between_calls": "idle-millis-between-calls",
    "call_for_empty_lists": "call-process-records-even-for-empty-record-list",
    "validate_sequence_number": "validate-sequence-number-before-checkpointing",
    "shutdown_grace_ms": "shutdown-grace",
}

# Most that one micro-batch reads where nothing is configured.
BATCH_BYTES = 64 * 1024**3

# Units of a duration, in milliseconds.
_UNITS = {
    "ms": 1, "millis": 1, "milliseconds": 1, "millisecond": 1,
    "s": 1000, "second": 1000, "seconds": 1000,
    "m": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}


@dataclass(frozen=True)
class Overrides:
    """Settings that take the place of configured ones; None leaves the configured value."""

    initial_position: str | None = None
    timestamp: datetime | None = None
    max_records: int | None = None
    max_records_count: int | None = None
    max_cache_byte_size: int | None = None
    idle_time_between_reads_ms: int | None = None
    idle_millis_between_calls: int | None = None
    call_for_empty_lists: bool | None = None
    validate_sequence_number: bool | None = None
    shutdown_grace_ms: int | None = None


@dataclass(frozen=True)
class SourceOptions:
    """Resolved settings. None means the setting is left to Spark."""

    initial_position: str = LATEST
    timestamp: datetime | None = None
    max_records: int = 10_000
    max_records_count: int | None = None
    max_cache_byte_size: int | None = None
    idle_time_between_reads_ms: int = 1000
    idle_millis_between_calls: int | None = None
    call_for_empty_lists: bool | None = None
    validate_sequence_number: bool = True
    shutdown_grace_ms: int | None = None

    def __post_init__(self):
        if self.initial_position not in POSITIONS:
            raise ValueError(f"initial position must be one of {', '.join(POSITIONS)}, not {self.initial_position!r}")
        if self.max_records < 1:
            raise ValueError("max_records must be at least 1")

    @property
    def start_position(self) -> str:
        """A timestamp override asks for reading from that time, whatever the position says."""
        return AT_TIMESTAMP if self.timestamp is not None else self.initial_position

    @property
    def fetch_records(self) -> int:
        """Records per fetch: the smaller of the two limits."""
        return min(self.max_records, self.max_records_count or self.max_records)

    @property
    def poll_interval_ms(self) -> int:
        return max(self.idle_time_between_reads_ms, self.idle_millis_between_calls or 0)

    def trigger(self) -> dict[str, str]:
        """Arguments for ``DataStreamWriter.trigger``."""
        return {"processingTime": f"{self.poll_interval_ms} milliseconds"}

    def reader_options(self) -> dict[str, str]:
        """Options of the file stream: the byte ceiling of one micro-batch, which always has one."""
        return {"maxBytesPerTrigger": str(self.max_cache_byte_size or BATCH_BYTES)}

    def session_conf(self) -> dict[str, str]:
        """Settings of the stream's session that are configured. Empty micro-batches only reach stateful queries on Spark.

        No grace is left to Spark, for which a timeout of 0 means to wait without end.
        """
        conf = {}
        if self.call_for_empty_lists is not None:
            conf["spark.sql.streaming.noDataMicroBatches.enabled"] = str(self.call_for_empty_lists).lower()
        if self.shutdown_grace_ms:
            conf["spark.sql.streaming.stopTimeout"] = str(self.shutdown_grace_ms)
        return conf


def resolve_options(config: Mapping[str, object] | None = None, overrides: Overrides | None = None) -> SourceOptions:
    """Settings from a flat mapping with the keys of ``KEYS`` at its root."""
    config = config or {}
    chosen: dict[str, object] = {}
    for setting in fields(SourceOptions):
        name = setting.name
        override = getattr(overrides, name) if overrides is not None else None
        key = KEYS.get(name)
        if override is not None:
            chosen[name] = override
        elif key is not None and config.get(key) is not None:
            chosen[name] = _convert(name, config[key])
    return SourceOptions(**chosen)


def _convert(name: str, value: object) -> object:
    if name == "initial_position":
        return str(value)
    if name in ("call_for_empty_lists", "validate_sequence_number"):
        return _boolean(name, value)
    if name in ("idle_time_between_reads_ms", "shutdown_grace_ms"):
        return _millis(name, value)
    return int(value)


def _boolean(name: str, value: object) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).lower()
    if text not in ("true", "false"):
        raise ValueError(f"{name} must be true or false, not {value!r}")
    return text == "true"


def _millis(name: str, value: object) -> int:
    if isinstance(value, int):
        return value
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", str(value))
    if not found or (found[2] or "ms") not in _UNITS:
        raise ValueError(f"{name} is not a duration: {value!r}")
    return int(found[1]) * _UNITS[found[2] or "ms"]
