from datetime import datetime

import pytest

from shardstream.sources.options import Overrides, SourceOptions, resolve_options


def test_override_then_config_then_default():
    config = {"max-records": 50, "initial-position-in-stream": "TRIM_HORIZON", "unknown-key": 1}
    options = resolve_options(config, Overrides(max_records=7))
    assert options.max_records == 7
    assert options.initial_position == "TRIM_HORIZON"
    assert options.idle_time_between_reads_ms == SourceOptions().idle_time_between_reads_ms
    assert resolve_options() == SourceOptions()


def test_false_and_zero_overrides_count():
    config = {"validate-sequence-number-before-checkpointing": True, "shutdown-grace": "3 seconds"}
    options = resolve_options(config, Overrides(validate_sequence_number=False, shutdown_grace_ms=0))
    assert not options.validate_sequence_number
    assert options.shutdown_grace_ms == 0


@pytest.mark.parametrize("text, millis", [("250", 250), ("2s", 2000), ("3 minutes", 180_000), (40, 40), ("1 hour", 3_600_000)])
def test_durations(text, millis):
    assert resolve_options({"idle-time-between-reads": text}).idle_time_between_reads_ms == millis


@pytest.mark.parametrize(
    "config",
    [
        {"idle-time-between-reads": "soon"},
        {"initial-position-in-stream": "MIDDLE"},
        {"call-process-records-even-for-empty-record-list": "maybe"},
        {"max-records": 0},
    ],
)
def test_bad_values_are_refused(config):
    with pytest.raises(ValueError):
        resolve_options(config)


def test_what_spark_gets():
    options = resolve_options(
        {
            "max-records": 500,
            "max-records-count": 200,
            "max-cache-byte-size": 1000,
            "idle-time-between-reads": "1s",
            "idle-millis-between-calls": 1500,
            "call-process-records-even-for-empty-record-list": "true",
        }
    )
    assert options.fetch_records == 200
    assert options.trigger() == {"processingTime": "1500 milliseconds"}
    assert options.reader_options() == {"maxBytesPerTrigger": "1000"}
    assert options.session_conf() == {"spark.sql.streaming.noDataMicroBatches.enabled": "true"}
    plain = resolve_options({})
    assert plain.session_conf() == {} and int(plain.reader_options()["maxBytesPerTrigger"]) > 0


def test_a_timestamp_sets_the_position():
    assert resolve_options({}, Overrides(timestamp=datetime(2024, 1, 1))).start_position == "AT_TIMESTAMP"
