"""Fetches that are filled one after another up to both bounds, without one task that reads a whole shard.

Where a fetch starts depends on where the one before it ended. A shard is cut into blocks of rows, and for every row of a
block at which the first fetch of the block could start, the block says which of its rows the last fetch then
starts at, and how many there are. That is a function from what is open before a block to what is open after it, so going
along a shard takes one look-up per block; after it all blocks number their rows by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.operators.fetch import DEFAULT_MAX_RECORDS
from shardstream.operators.ordering import with_position
from shardstream.operators.shards import join_small

# Rows of a block, of which three numbers each go to one task. Of every block, as many rows as a fetch may have are passed on.
BLOCK_ROWS = 500_000

_STARTS = "shard_id string, block bigint, offset bigint, end bigint, open_position bigint, open_bytes bigint, fetches bigint"
_ENTRIES = "shard_id string, block bigint, first bigint, number bigint"
_PLACES = "shard_id string, position bigint, fetch_no bigint"


def with_full_fetch(
    records: DataFrame,
    max_records: int = DEFAULT_MAX_RECORDS,
    max_bytes: int | None = None,
    window_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Cut every shard, in sequence order, into fetches that take records as long as there are at most ``max_records`` of
    them and their payloads have at most ``max_bytes``; a longer record is a fetch of its own.

    ``fetch_no`` goes up by one from 0 in every shard, as if the shard were read from its start. A null payload has no
    bytes, and an empty log no fetches. The payloads are read twice, for their lengths and to be handed on, and are joined
    with their numbers once.
    """
    if max_records < 1 or (max_bytes is not None and max_bytes < 1) or block_rows < 1:
        raise ValueError("max_records, max_bytes and block_rows must be at least 1")
    if max_bytes is None:
        numbered = with_position(records, into="fetch_no", window_rows=window_rows)
        return numbered.withColumn("fetch_no", F.expr(f"fetch_no div {int(max_records)}"))
    rows = max(block_rows, max_records)
    size = F.coalesce(F.octet_length("data"), F.lit(0)).cast("bigint")
    narrow = records.select("shard_id", "sequence_number", size.alias("size"))
    narrow = with_position(narrow, also={"before": F.col("size")}, window_rows=window_rows)
    narrow = narrow.select("shard_id", F.expr(f"position div {rows}").alias("block"), "position", "before", "size")

    def starts(block: pa.Table) -> pa.Table:
        block, following = _following(block, max_records, max_bytes)
        n = len(following)
        last, fetches = list(range(n)), [1] * n
        for at in range(n - 1, -1, -1):
            if (to := following[at]) < n:
                last[at], fetches[at] = last[to], 1 + fetches[to]
        could = min(n, max_records)
        position, before, length = (block[c].to_numpy() for c in ("position", "before", "size"))
        opened = np.array(last[:could])
        return pa.table(
            {
                "shard_id": block["shard_id"].slice(0, could),
                "block": block["block"].slice(0, could),
                "offset": np.arange(could),
                "end": (before + length)[:could],
                "open_position": position[opened],
                "open_bytes": before[opened],
                "fetches": np.array(fetches[:could]),
            }
        )

    blocks = narrow.groupBy("shard_id", "block").applyInArrow(starts, _STARTS)
    along = blocks.repartition("shard_id").sortWithinPartitions("shard_id", "block", "offset")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: tuple[str, int, int, int] | None = None  # shard, position and bytes where the open fetch starts, next number
        for (shard, block), could in _blocks(batches):
            if open_ is None or open_[0] != shard:
                first, number = 0, 0
            else:
                _, position, before, number = open_
                full = int(np.searchsorted(could["end"], before + max_bytes, "right"))
                first = min(position + max_records - block * rows, full)
            entry = {"shard_id": [shard], "block": [block], "first": [first], "number": [number]}
            yield pa.RecordBatch.from_pydict(entry)
            if first < len(could["end"]):
                at = (int(could[c][first]) for c in ("open_position", "open_bytes", "fetches"))
                position, before, fetches = at
                open_ = shard, position, before, number + fetches

    entries = along.mapInArrow(enter, _ENTRIES)

    def number(block: pa.Table) -> pa.Table:
        block, following = _following(block, max_records, max_bytes)
        begins = np.zeros(len(following), np.int64)
        at = block["first"][0].as_py()
        while at < len(following):
            begins[at] = 1
            at = following[at]
        numbers = block["number"][0].as_py() - 1 + np.cumsum(begins)
        return pa.table({"shard_id": block["shard_id"], "position": block["position"], "fetch_no": numbers})

    placed = join_small(narrow, entries, ["shard_id", "block"], "inner", salt_by="position")
    places = placed.groupBy("shard_id", "block").applyInArrow(number, _PLACES)
    numbered = with_position(records, into="_position", window_rows=window_rows)
    places = places.withColumnRenamed("position", "_position")
    return numbered.join(places, ["shard_id", "_position"]).select(*records.columns, "fetch_no")


def _following(block: pa.Table, max_records: int, max_bytes: int) -> tuple[pa.Table, list[int]]:
    """The block in order, and for each row the one at which the next fetch starts if one starts there."""
    block = block.sort_by("position")
    before, size = block["before"].to_numpy(), block["size"].to_numpy()
    here = np.arange(len(before))
    full = np.searchsorted(before + size, before + max_bytes, "right")
    return block, np.minimum(here + max_records, np.maximum(here + 1, full)).tolist()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], dict[str, np.ndarray]]]:
    """Shard and number of every block with its rows; a block may be spread over batches."""
    key, parts = None, []

    def whole():
        return key, {c: np.concatenate([p.column(c).to_numpy() for p in parts]) for c in parts[0].schema.names if c != "shard_id"}

    for batch in batches:
        shards, numbers = batch.column("shard_id").to_pylist(), batch.column("block").to_pylist()
        changes = [k for k in range(1, len(numbers)) if (shards[k], numbers[k]) != (shards[k - 1], numbers[k - 1])]
        for start, stop in zip([0, *changes], [*changes, len(numbers)], strict=True):
            if stop == start:
                continue
            if parts and key != (shards[start], numbers[start]):
                yield whole()
                parts = []
            key = shards[start], numbers[start]
            parts.append(batch.slice(start, stop - start))
    if parts:
        yield whole()
