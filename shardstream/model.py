"""Column layout of logs, record sets, progress tables and put results (DDL strings)."""

RECORD = (
    "stream_name string, shard_id string, sequence_number string, "
    "partition_key string, data binary, arrival_ts timestamp"
)
RECORD_COLUMNS = ("stream_name", "shard_id", "sequence_number", "partition_key", "data", "arrival_ts")

COMMITTABLE = RECORD + ", starting_sequence_number string, millis_behind_latest bigint"
COMMITTABLE_COLUMNS = (*RECORD_COLUMNS, "starting_sequence_number", "millis_behind_latest")

# Fields of one element of a record set's `records` array, in order: the first one sorts the array.
SET_RECORD_FIELDS = ("sequence_number", "stream_name", "partition_key", "data", "arrival_ts")

PROGRESS = "shard_id string, sequence_number string, shutdown_reason string"

PUT_REQUEST = "request_id string, stream_name string, partition_key string, data binary"

ATTEMPTS = "array<struct<attempt int, successful boolean, error_code string, error_message string>>"
PUT_RESULT = f"request_id string, shard_id string, sequence_number string, successful boolean, attempts {ATTEMPTS}"

# Positions a progress row can hold instead of a sequence number.
TRIM_HORIZON = "TRIM_HORIZON"
LATEST = "LATEST"
AT_TIMESTAMP = "AT_TIMESTAMP"
SHARD_END = "SHARD_END"

# The shutdown reason that marks a shard as finished; every other reason only stops commits.
TERMINATE = "TERMINATE"

# A sequence number written here is the batch and the place in it, each padded to this many digits, so
# that string order is put order. Any 64-bit number has room.
SEQUENCE_PART = 19
