"""Hard negatives: for each anchor and positive, the best rows of other labels in a window under the positive's score.

Scores are integers, so that ties and windows are exact. Anchors are worked through in blocks against all rows. A first
pass finds every anchor's positives, and with them the windows; a second one keeps, for every window, the best rows that
a task has seen. These few pairs are shuffled by anchor and sorted by one packed key: score downwards, then id. The sorted
rows are read as a stream that opens a window at each positive and hands out negatives until it is full; an
anchor's rows are never held together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import partitions, pin

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90
#: Rows of a chunk, anchors of a block, and anchors multiplied with a chunk at a time.
CHUNK, BLOCK, AT_ONCE = 4096, 8192, 256
#: Scores must stay below this, so that double precision is exact and a place in a chunk fits beside them.
LARGEST = 1 << 50
NONE = np.iinfo(np.int64).min

PACKED = "n bigint, dims int, ids binary, labels binary, vectors binary, windows binary"
TILE_COLUMNS = [c.split()[0] for c in PACKED.split(", ")]
PAIR = "anchor_id bigint, key binary, positive boolean"
MINED = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
)


def usable(vector: Column | str) -> Column:
    """A vector that is there and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def packed_keys(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """16 bytes each, whose byte order is that of higher scores and then smaller ids."""
    flip = np.uint64(1 << 63)
    parts = [~(scores.astype(np.int64).view(np.uint64) ^ flip), ids.astype(np.int64).view(np.uint64) ^ flip]
    return np.stack(parts, 1).astype(">u8")


def unpacked(key: bytes) -> tuple[int, int]:
    """(score, id) of a key."""
    score, row = int.from_bytes(key[:8], "big"), int.from_bytes(key[8:], "big")
    return (1 << 63) - 1 - score, row - (1 << 63)


def packed(rows: DataFrame, most: int) -> DataFrame:
    """Rows (id, label, vector, windows) of a partition as tables of at most ``most`` rows, one row each, vectors of one
    length together and ids ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths):
                mine = waiting.setdefault(int(dims), [])
                mine.append(batch.filter(pa.array(lengths == dims)))
                if sum(b.num_rows for b in mine) >= most:
                    table = pa.Table.from_batches(mine)
                    whole = table.num_rows // most * most
                    yield from (one(table.slice(at, most), int(dims)) for at in range(0, whole, most))
                    waiting[int(dims)] = table.slice(whole).to_batches()
        for dims, mine in waiting.items():
            if any(b.num_rows for b in mine):
                yield one(pa.Table.from_batches(mine), dims)

    def one(table: pa.Table, dims: int) -> pa.RecordBatch:
        table = table.sort_by("id").combine_chunks()

        def raw(name: str, kind) -> bytes:
            column = table.column(name).combine_chunks()
            flat = column.flatten() if pa.types.is_list(column.type) else column
            return flat.to_numpy(zero_copy_only=False).astype(kind).tobytes()

        values = [table.num_rows, dims, raw("id", "<i8"), raw("label", "<i8"), raw("vector", "<i8"), raw("windows", "<i8")]
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        arrays = [pa.array([v], t) for v, t in zip(values, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=TILE_COLUMNS)

    return rows.select("id", "label", "vector", F.size("vector").alias("dims"), "windows").mapInArrow(run, PACKED)


class Tile:
    """The arrays of one packed row."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.vectors = np.frombuffer(row["vectors"], "<i8").reshape(row["n"], row["dims"]).astype(np.float64)
        windows = np.frombuffer(row["windows"], "<i8")
        self.windows = windows.reshape(row["n"], len(windows) // row["n"])
        self.largest = float(np.abs(self.vectors).max(initial=0))


def products(anchors: Tile, rows: slice, others: Tile) -> np.ndarray:
    """Exact integer inner products."""
    if anchors.largest * others.largest * max(1, anchors.vectors.shape[1]) >= LARGEST:
        raise ValueError("the vectors are too large: a score could pass 2 ** 50")
    return (anchors.vectors[rows] @ others.vectors.T).astype(np.int64)


def best_of(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the k best allowed scores and their ids, ids ascending along the line; NONE where there are fewer."""
    n = scores.shape[1]
    ranked = np.where(allowed, scores * CHUNK + (CHUNK - 1 - np.arange(n)), NONE)
    if n > k:
        ranked = np.partition(ranked, n - k, axis=1)[:, n - k :]
    found = ranked != NONE
    at = np.where(found, CHUNK - 1 - ranked % CHUNK, 0)
    return np.where(found, ranked // CHUNK, NONE), np.where(found, ids[at], 0)


def merged(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best along the last axis: higher scores, then smaller ids."""
    order = np.argsort(ids, axis=-1, kind="stable")
    scores, ids = (np.take_along_axis(x, order, -1) for x in (scores, ids))
    order = np.argsort(-scores, axis=-1, kind="stable")[..., :k]
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


class Best:
    """For every anchor of a block and each of its windows, the best rows so far."""

    def __init__(self, anchors: Tile, windows: int, k: int):
        shape = (len(anchors.ids), windows, k)
        self.k, self.scores, self.ids = k, np.full(shape, NONE), np.zeros(shape, np.int64)

    def add(self, rows: slice, window: int, scores: np.ndarray, ids: np.ndarray) -> None:
        both = [np.concatenate([old[rows, window], new], 1) for old, new in ((self.scores, scores), (self.ids, ids))]
        # Absent entries sort last: they take the lowest score that can be negated.
        low = np.where(both[0] == NONE, NONE + 1, both[0])
        scores, ids = merged(low, both[1], self.k)
        width = scores.shape[1]
        self.scores[rows, window, :width] = np.where(scores == NONE + 1, NONE, scores)
        self.ids[rows, window, :width] = ids

    def pairs(self, anchors: Tile, positive: bool) -> pa.RecordBatch:
        """Every pair once, however many windows it is in."""
        row, window, at = np.nonzero(self.scores != NONE)
        anchor, score, other = anchors.ids[row], self.scores[row, window, at], self.ids[row, window, at]
        kept = np.unique(np.stack([row, other], 1), axis=0, return_index=True)[1] if len(row) else np.zeros(0, int)
        keys = packed_keys(score[kept], other[kept])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor[kept], pa.int64()),
                pa.array([k.tobytes() for k in keys], pa.binary()),
                pa.array(np.full(len(kept), positive)),
            ],
            names=["anchor_id", "key", "positive"],
        )


def tile_pairs(
    chunks: DataFrame, blocks: DataFrame, meet: Callable[[Tile, Tile, Best], None], windows: int, k: int, positive: bool
) -> DataFrame:
    """The best pairs of every block of anchors with every group of chunks.

    All rows are a block or a chunk in one table, dealt out by block and group of chunks; a task reads a block and then, one
    at a time, the chunks that meet it. Few blocks meet many groups of chunks, and many blocks few, so that there are
    a few tasks for each core however many rows are anchors.
    """
    known = [r["at"] for r in blocks.select("at").collect()]  # one number for each block of anchors
    groups = max(1, -(-2 * partitions(chunks.sparkSession) // max(1, len(known))))
    blocks = blocks.select(
        F.col("at").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.lit(-1).cast("long").alias("chunk"),
        *TILE_COLUMNS,
    )
    chunks = chunks.select(
        F.explode(F.array(*map(F.lit, known)).cast("array<bigint>")).alias("block"),
        F.pmod(F.xxhash64("at"), F.lit(groups)).cast("int").alias("group"),
        F.col("at").alias("chunk"),
        *TILE_COLUMNS,
    )
    dealt = blocks.unionByName(chunks).repartition(max(1, len(known) * groups), "block", "group")
    dealt = dealt.sortWithinPartitions("block", "group", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best, where = None, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["chunk"] < 0:
                    if anchors is not None:
                        yield best.pairs(anchors, positive)
                    anchors, where = Tile(row), (row["block"], row["group"])
                    best = Best(anchors, windows, k)
                elif where == (row["block"], row["group"]):
                    others = Tile(row)
                    if others.vectors.shape[1] == anchors.vectors.shape[1]:
                        meet(anchors, others, best)
        if anchors is not None:
            yield best.pairs(anchors, positive)

    return dealt.mapInArrow(run, PAIR)


def meet_positives(anchors: Tile, others: Tile, best: Best) -> None:
    for at in range(0, len(anchors.ids), AT_ONCE):
        rows = slice(at, at + AT_ONCE)
        scores = products(anchors, rows, others)
        allowed = (anchors.labels[rows, None] == others.labels) & (anchors.ids[rows, None] != others.ids)
        best.add(rows, 0, *best_of(scores, allowed, others.ids, best.k))


def meet_negatives(least: int, most: int) -> Callable[[Tile, Tile, Best], None]:
    def meet(anchors: Tile, others: Tile, best: Best) -> None:
        for at in range(0, len(anchors.ids), AT_ONCE):
            rows = slice(at, at + AT_ONCE)
            scores = products(anchors, rows, others)
            scores_100 = scores * 100
            different = anchors.labels[rows, None] != others.labels
            for window in range(anchors.windows.shape[1]):
                top = anchors.windows[rows, window, None]
                allowed = different & (top != NONE) & (least * top <= scores_100) & (scores_100 <= most * top)
                if allowed.any():
                    best.add(rows, window, *best_of(scores, allowed, others.ids, best.k))

    return meet


def stream_windows(least: int, most: int, per_positive: int) -> Callable:
    """From pairs in the order (anchor, key), the negatives of every positive.

    A positive with a score above 0 comes before all that its window may hold. One with 0 has a window of zeros only, which
    come in the order of ids around it; the first of them are remembered. Under a negative score a window is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, open_, zeros = None, [], []
        out: list[tuple] = []

        def hand_out(window: list, score: int, row: int) -> None:
            window[2] += 1
            out.append((anchor, window[1], window[2], row, window[0], score))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("anchor_id", "key", "positive"))
            for at, key, positive in zip(*columns, strict=True):
                if at != anchor:
                    anchor, open_, zeros = at, [], []
                score, row = unpacked(key)
                if positive:
                    window = [score, row, 0]
                    open_.append(window)
                    if score == 0:
                        for earlier in zeros[:per_positive]:
                            hand_out(window, 0, earlier)
                    continue
                if score == 0 and len(zeros) < per_positive:
                    zeros.append(row)
                for window in open_:
                    if window[2] < per_positive and least * window[0] <= 100 * score <= most * window[0]:
                        hand_out(window, score, row)
            if out:
                yield _mined(out)
                out = []

    return run


def _mined(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in MINED.split(", ")]
    types = [pa.int32() if c.split()[1] == "int" else pa.int64() for c in MINED.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def mine_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """For each anchor and each of its positives, the first ``negatives`` rows of other labels whose score is in the
    window ``least`` * positive <= 100 * negative <= ``most`` * positive.

    ``vector_col`` holds whole numbers, a row's score with an anchor is their inner product. Higher scores come first, ties by
    smaller id. An anchor's positives are its first ``positives`` other rows of the same label. ``anchors`` says over the
    columns of ``rows`` which rows are anchors. Gives (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score), ``rank`` from 1; a positive with nothing in its window has no row.

    Rows with a null id, label or vector, or with null components, take no part; an empty vector scores 0. Vectors of another
    length than the anchor's are not scored with it. Of rows that repeat an id, the one with the smallest label and
    then the smallest vector takes part. Scores of 2 ** 50 and more stop the job. An empty table, or one without
    anchors, gives an empty table. Other columns are not read, unless ``anchors`` reads them.
    """
    if not (0 <= least < most < 100 and positives > 0 and negatives > 0):
        raise ValueError("a window must lie between 0 and below the positive's score, and hold at least one row")
    whole = F.forall(vector_col, lambda x: x.isNotNull())
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & whole)
    rows = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<bigint>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    rows = pin(rows, "rows")
    repeated = rows.groupBy("id").count().filter("count > 1")
    if not repeated.isEmpty():
        several = rows.join(repeated.select("id"), "id", "left_semi")
        one = several.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("row")).select("id", "row.*")
        rows = pin(rows.join(repeated.select("id"), "id", "left_anti").unionByName(one), "rows")
    none = F.array().cast("array<bigint>")
    chunks = _numbered(packed(rows.withColumn("windows", none), CHUNK), "chunks")
    wanted = pin(rows.filter("anchor"), "anchors")
    n_wanted = wanted.count()

    def in_blocks(wanted: DataFrame) -> DataFrame:
        return _numbered(packed(wanted.coalesce(max(1, -(-n_wanted // BLOCK))), BLOCK), "blocks")

    found = tile_pairs(chunks, in_blocks(wanted.withColumn("windows", none)), meet_positives, 1, positives, True)
    # A group of chunks gives at most ``positives`` keys of an anchor; the smallest of all are its positives.
    firsts = found.groupBy("anchor_id").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    firsts = pin(firsts.select("anchor_id", F.slice("keys", 1, positives).alias("keys")), "positives")
    tops = F.transform("keys", _score)
    tops = [F.coalesce(F.try_element_at(tops, F.lit(k + 1)), F.lit(NONE)) for k in range(positives)]
    windows = firsts.select(F.col("anchor_id").alias("id"), F.array(*tops).alias("windows"))
    with_windows = pin(wanted.join(windows, "id"), "windows")

    others = tile_pairs(chunks, in_blocks(with_windows), meet_negatives(least, most), positives, negatives, False)
    same = firsts.select("anchor_id", F.explode("keys").alias("key"), F.lit(True).alias("positive"))
    pairs = same.unionByName(others).repartition("anchor_id").sortWithinPartitions("anchor_id", "key")
    return pairs.mapInArrow(stream_windows(least, most, negatives), MINED)


def _numbered(tiles: DataFrame, purpose: str) -> DataFrame:
    return pin(tiles.withColumn("at", F.monotonically_increasing_id()), purpose)


def _score(key: Column) -> Column:
    """The score in a packed key, as ``unpacked`` reads it."""
    high = F.conv(F.hex(F.substring(key, 1, 8)), 16, 10).cast("decimal(20,0)")
    return (F.lit((1 << 63) - 1) - high).cast("long")
