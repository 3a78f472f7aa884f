"""A processor with a life per shard: it starts, is given the shard's records, keeps a state, and is ended once.

Work on records is done per fetch, on many workers; what is done in sequence is to take one small row per fetch into the state. So
a shard with very many records is one task only for these rows, which are read as a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shardstream.model import TERMINATE
from shardstream.operators.fetch import DEFAULT_MAX_RECORDS, with_fetch
from shardstream.operators.sets import process_record_sets
from shardstream.session import settle

STATE, OUTPUT = "state", "output"
# The order of a shard's rows: its former state, that it was taken away, its fetches, that it has ended.
_FORMER, _LOST, _FETCH, _END = range(4)
_ROWS_AT_ONCE = 1000


@dataclass(frozen=True)
class ShardProcessor:
    """What a user gives for the life of a shard. States, parts and outputs are dicts of the fields of their DDL schemas.

    ``initialise(shard_id)`` gives the first state. ``process(records)`` makes a part of a fetch, an Arrow table in
    sequence order; it does not see the state. ``advance(state, part)`` is called per fetch in sequence order
    and gives the next state and a list of outputs. ``end(state, reason)`` gives the last outputs.
    """

    initialise: Callable[[str], dict]
    process: Callable[[pa.Table], dict]
    advance: Callable[[dict, dict], tuple[dict, list[dict]]]
    end: Callable[[dict, str], list[dict]]
    state: str
    part: str
    output: str


def life_schema(processor: ShardProcessor) -> str:
    """Columns of what ``process_shards`` returns."""
    return (
        "shard_id string, last_sequence_number string, ended_by string, "
        f"state struct<{processor.state}>, output struct<{processor.output}>, kind string"
    )


def process_shards(
    records: DataFrame,
    processor: ShardProcessor,
    states: DataFrame | None = None,
    status: DataFrame | None = None,
    max_records: int = DEFAULT_MAX_RECORDS,
    max_bytes: int | None = None,
    window_rows: int | None = None,
) -> DataFrame:
    """Go on with the life of every shard: its outputs in rows of kind ``output``, its state in one of kind ``state``.

    ``states`` are the state rows of the run before, ``status`` the shutdown reasons. A shard starts with its first
    record. A terminated one ends after the record that its ``ending_sequence_number`` names; as long as the status does not
    name one, it goes on. Any other reason ends it at once, and its records are left to whoever has it now; if it comes back
    without a reason, it starts anew. An ended shard keeps its state, and ``end`` is not called again. Without
    records and states the result is empty.
    """
    fetches = with_fetch(records, max_records, max_bytes, window_rows)

    def measure(fetch: pa.Table) -> pa.Table:
        last = fetch.slice(fetch.num_rows - 1)
        part = pa.array([processor.process(fetch)], out_part)
        return pa.table({"shard_id": last["shard_id"], "number": last["fetch_no"], "last": last["sequence_number"], "part": part}).cast(row)

    measured = f"shard_id string, number bigint, last string, part struct<{processor.part}>"
    row = _arrow(measured)
    out_part = row.field("part").type
    events = process_record_sets(fetches, measure, measured).withColumn("step", F.lit(_FETCH))
    if states is not None:
        former = states.where(F.col("kind") == STATE)
        former = former.select("shard_id", F.col("last_sequence_number").alias("last"), "ended_by", "state")
        events = events.unionByName(former.withColumn("step", F.lit(_FORMER)), allowMissingColumns=True)
    else:
        none = F.lit(None)
        events = events.withColumns({"ended_by": none.cast("string"), "state": none.cast(f"struct<{processor.state}>")})
    if status is not None:
        known = "ending_sequence_number" in status.columns
        ending = F.col("ending_sequence_number") if known else F.lit(None).cast("string")
        over = status.where(F.col("shutdown_reason").isNotNull()).select(
            "shard_id",
            F.when(F.col("shutdown_reason") == TERMINATE, F.lit(_END)).otherwise(F.lit(_LOST)).alias("step"),
            ending.alias("last"),
            F.col("shutdown_reason").alias("ended_by"),
        )
        events = events.unionByName(over, allowMissingColumns=True)
    wanted = ["shard_id", "step", "last", "ended_by", "state", "part"]
    ordered = events.repartition("shard_id").sortWithinPartitions("shard_id", "step", "number").select(*wanted)
    schema = life_schema(processor)
    out = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        life = None
        for batch in batches:
            for event in batch.to_pylist():
                if life is None or life.shard_id != event["shard_id"]:
                    made += life.rest() if life else []
                    life = _Life(processor, event["shard_id"])
                made += life.take(event)
                if len(made) >= _ROWS_AT_ONCE:
                    yield pa.RecordBatch.from_pylist(made, out)
                    made = []
        made += life.rest() if life else []
        if made:
            yield pa.RecordBatch.from_pylist(made, out)

    return ordered.mapInArrow(run, schema)


class _Life:
    """One shard's part of a run."""

    def __init__(self, processor: ShardProcessor, shard_id: str):
        self.processor, self.shard_id = processor, shard_id
        self.state = self.last = self.ended_by = None
        self.lost = False

    def take(self, event: dict) -> list[dict]:
        step = event["step"]
        if step == _FORMER:
            self.state, self.last, self.ended_by = event["state"], event["last"], event["ended_by"]
            return []
        if step == _LOST:
            self.lost = True
            return self._end(event["ended_by"])
        if step == _END:
            reached = None not in (self.last, event["last"]) and self.last >= event["last"]
            return self._end(event["ended_by"]) if reached and not self.lost else []
        if self.lost or self.ended_by == TERMINATE:
            return []
        if self.state is None or self.ended_by is not None:
            self.state, self.ended_by = self.processor.initialise(self.shard_id), None
        self.state, outputs = self.processor.advance(self.state, event["part"])
        self.last = event["last"] if self.last is None else max(self.last, event["last"])
        return self._rows(outputs)

    def _end(self, reason: str) -> list[dict]:
        if self.state is None or self.ended_by is not None:
            return []
        self.ended_by = reason
        return self._rows(self.processor.end(self.state, reason))

    def _rows(self, outputs: list[dict]) -> list[dict]:
        same = {"shard_id": self.shard_id, "last_sequence_number": self.last, "ended_by": self.ended_by, "kind": OUTPUT}
        return [{**same, "output": output} for output in outputs]

    def rest(self) -> list[dict]:
        if self.state is None:
            return []
        row = {"shard_id": self.shard_id, "last_sequence_number": self.last, "ended_by": self.ended_by, "kind": STATE}
        return [{**row, "state": self.state}]


def shard_states(lives: DataFrame) -> DataFrame:
    """State rows, computed once and kept, to go on with."""
    return settle(lives.where(F.col("kind") == STATE))


def shard_outputs(lives: DataFrame) -> DataFrame:
    """The outputs with their own columns; a shard's name is among them if the processor puts it there."""
    return lives.where(F.col("kind") == OUTPUT).select("output.*")


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))
