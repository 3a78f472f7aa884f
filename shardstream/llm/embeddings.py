"""Near copies among embeddings: products of int8 tiles with an error bound per vector, checked in full precision.

Vectors meet in cells around pivots. A vector lives in the cell of its nearest pivot and visits every other cell of which
a vector could be near enough, so that each pair that links meets exactly once. A cell is cut into tiles of a
bounded number of rows; one task multiplies two tiles at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import pin
from shardstream.llm.components import connected_components

COSINE = 0.95
#: Pivots are a sample of the vectors, one for so many of them and at most MOST_PIVOTS; what is broadcast is bounded.
ROWS_PER_PIVOT, MOST_PIVOTS = 4096, 2048
TILE, BLOCK = 4096, 512
#: Products of so many int8 numbers are exact in single precision.
EXACT_TERMS = (1 << 24) // 127**2
SLACK, ROUNDING = 1e-9, 1e-4


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Each row scaled to length 1; first by its largest component, so that no square is lost."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, and the length of what each vector loses."""
    scale = np.abs(units).max(1, keepdims=True) / 127
    codes = np.rint(units / scale)
    lost = np.linalg.norm(units - codes * scale, axis=1) + SLACK
    return codes.astype(np.int8), scale[:, 0], lost


def near_pairs(left: np.ndarray, right: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in two tiles of unit vectors whose cosine reaches the limit.

    With u = u' + e and v = v' + f, u.v differs from u'.v' by at most |u'||f| + |e||v|, where |u'| <= 1 + |e| and |v| = 1. Pairs
    that this leaves open are computed in double precision; the others are decided by their codes.
    """
    (a, a_scale, a_lost), (b, b_scale, b_lost) = quantised(left), quantised(right)
    worst = (1 + a_lost.max()) * b_lost.max() + a_lost.max()
    found = []
    for at in range(0, len(a), BLOCK):
        rows = slice(at, at + BLOCK)
        product = np.zeros((len(a[rows]), len(b)), np.float32)
        for k in range(0, a.shape[1], EXACT_TERMS):
            terms = slice(k, k + EXACT_TERMS)
            product += a[rows, terms].astype(np.float32) @ b[:, terms].astype(np.float32).T
        # A first look with the largest bound of the tiles, and room for the rounding of single precision.
        x, y = np.nonzero(product * b_scale.astype(np.float32) >= ((cosine - worst - ROUNDING) / a_scale[rows])[:, None])
        near = product[x, y].astype(np.float64) * a_scale[rows][x] * b_scale[y]
        x += at
        bound = (1 + a_lost[x]) * b_lost[y] + a_lost[x] + (ROUNDING if a.shape[1] > EXACT_TERMS else SLACK)
        sure = near - bound >= cosine
        open_ = np.flatnonzero(~sure & (near + bound >= cosine))
        for k in range(0, len(open_), 1 << 16):
            part = open_[k : k + (1 << 16)]
            sure[part] = np.einsum("ij,ij->i", left[x[part]], right[y[part]]) >= cosine
        found.append((x[sure], y[sure]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep what the given ones connect: at most one for each vector of the tiles."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[q] = p
            kept.append((x, y))
    return kept


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def choose_pivots(classes: DataFrame, most: int) -> np.ndarray:
    """Unit vectors chosen by a hash of the id: the pivots are the same whenever the job runs."""
    wanted = min(most, classes.count() // ROWS_PER_PIVOT + 1)
    rows = classes.orderBy(F.xxhash64("rep"), "rep").limit(wanted).select("vector").collect()
    return unit_rows(np.array([r[0] for r in rows], np.float64))


def visits(classes: DataFrame, pivots: np.ndarray, cosine: float) -> DataFrame:
    """(cell, home, rep, m, vector): each vector in its own cell, and as a guest in those of lower number it could link into.

    If u is nearest to pivot p and v to q, u.(p - q) >= 0, and |u - v| <= d for d = sqrt(2 - 2 cosine); so v can only link with a
    vector of p's cell if v.q - v.p <= d |p - q|.
    """
    shared = classes.sparkSession.sparkContext.broadcast(pivots)
    distance = float(np.sqrt(2 - 2 * cosine))

    def run(batches):
        centers = shared.value
        apart = distance * np.sqrt(np.maximum(2 - 2 * centers @ centers.T, 0)) + 1e-6
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                near = unit_rows(matrix(part.column("vector"))) @ centers.T
                home = near.argmax(1)
                enters = near.max(1)[:, None] - near <= apart[home]
                enters &= np.arange(len(centers)) < home[:, None]
                enters[np.arange(len(home)), home] = True
                row, cell = np.nonzero(enters)
                for at in range(0, len(row), TILE):
                    r, c = row[at : at + TILE], cell[at : at + TILE]
                    where = [pa.array(c.astype(np.int32)), pa.array(home[r] == c)]
                    yield pa.RecordBatch.from_arrays([*where, *part.take(pa.array(r)).columns], ["cell", "home", *part.schema.names])

    kind = classes.schema["vector"].dataType.simpleString()
    rows = classes.select("rep", "m", "vector")
    return rows.mapInArrow(run, f"cell int, home boolean, rep bigint, m bigint, vector {kind}")


def tile_pairs(visiting: DataFrame, tile: int) -> DataFrame:
    """(cell, a, b, left, rep, m, vector): the rows of both tiles of every pair of tiles of a cell.

    Tiles of residents are numbered from 0, those of guests go on from there. Residents meet each other and all
    guests; guests do not meet. A resident goes to all pairs of its tile, a guest to one for each tile of residents, so
    a cell with very many rows is worked on by very many tasks.
    """
    counts = visiting.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("guests"))
    per = counts.select(
        "cell",
        F.ceil(F.col("homes") / tile).cast("int").alias("home_tiles"),
        F.ceil(F.col("guests") / tile).cast("int").alias("guest_tiles"),
    )
    rows = visiting.join(F.broadcast(per), "cell")  # one row per pivot
    spread, home_tiles = F.xxhash64("rep"), F.col("home_tiles")
    guest = home_tiles + F.pmod(spread, F.greatest("guest_tiles", F.lit(1)))
    own = F.when(F.col("home"), F.pmod(spread, home_tiles)).otherwise(guest).cast("int")
    rows = rows.withColumn("own", own).withColumn("before", F.least("own", "home_tiles"))

    def pair(a, b, left: bool):
        return F.struct(a.alias("a"), b.alias("b"), F.lit(left).alias("left"))

    own, none = F.col("own"), F.array().cast("array<struct<a: int, b: int, left: boolean>>")
    later = F.sequence(own, home_tiles + F.col("guest_tiles") - 1)
    earlier = F.sequence(F.lit(0), F.col("before") - 1)
    pairs = F.concat(
        F.when(F.col("home"), F.transform(later, lambda t: pair(own, t, True))).otherwise(none),
        F.when(F.col("before") > 0, F.transform(earlier, lambda t: pair(t, own, False))).otherwise(none),
    )
    return rows.select("cell", "rep", "m", "vector", F.explode(pairs).alias("pair")).select("cell", "pair.*", "rep", "m", "vector")


def tile_links(pairs: DataFrame, cosine: float) -> DataFrame:
    """(rep, n, other): for each pair of tiles, how many vectors of the other tile a vector links with, in rows without
    ``other``, and links that keep the tiles' vectors connected, in rows with it."""

    def run(table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy()
        sides = table.filter(pa.array(left)), table.filter(pa.array(~left))
        same = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        if same:
            sides = sides[0], sides[0]
        none = pa.table({"rep": pa.array([], "int64"), "n": pa.array([], "int64"), "other": pa.array([], "int64")})
        if not all(s.num_rows for s in sides):
            return none
        reps, many = ([s.column(c).to_numpy() for s in sides] for c in ("rep", "m"))
        x, y = near_pairs(*(unit_rows(matrix(s.column("vector"))) for s in sides), cosine)
        if same:
            x, y = x[x != y], y[x != y]
        counts = [np.bincount(x, many[1][y], len(reps[0])), np.bincount(y, many[0][x], len(reps[1]))][: 1 if same else 2]
        kept = spanning(reps[0][x], reps[1][y])
        rep = np.concatenate([*(r[c > 0] for r, c in zip(reps, counts, strict=False)), [a for a, _ in kept]])
        n = np.concatenate([*(c[c > 0] for c in counts), np.zeros(len(kept))])
        other = [None] * (len(rep) - len(kept)) + [b for _, b in kept]
        return pa.table({"rep": pa.array(rep, "int64"), "n": pa.array(n.astype(np.int64)), "other": pa.array(other, "int64")})

    return pairs.groupBy("cell", "a", "b").applyInArrow(run, "rep bigint, n bigint, other bigint")


def same_id_links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between the classes of different vectors that have one id; only rows whose id repeats are joined."""
    repeated = rows.groupBy("id").agg(F.count("*").alias("times")).filter("times > 1").select("id")
    held = rows.join(repeated, "id", "left_semi").join(classes.select("vector", "rep"), "vector").select("id", "rep").distinct()
    several = held.groupBy("id").agg(F.min("rep").alias("a"), F.count("*").alias("classes")).filter("classes > 1")
    return held.join(several, "id").filter("rep <> a").select("a", F.col("rep").alias("b"))


def near_copies(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most_pivots: int = MOST_PIVOTS,
    tile: int = TILE,
) -> DataFrame:
    """Link vectors whose cosine is ``cosine`` or more, and group them by links.

    One row per input row: the id as a long, ``n_links`` (other rows linked directly), ``component_id`` (the smallest id
    reachable) and ``kept``. Equal vectors are one class with a count, so copies are not compared. What leaves a pair of tiles is at
    most a count for each vector and links that keep them connected, however many pairs link.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing. Vectors of different
    length do not link. Rows that repeat an id are rows of their own for ``n_links`` and one node for groups. A row
    with a null id links with nothing and gets a null component, and is not kept. An empty table gives an empty
    table; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    classes = rows.filter("vector is not null").groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("m"))
    classes = pin(classes.withColumn("length", F.size("vector")), "classes")
    found = None
    for (length,) in classes.select("length").distinct().collect():
        alike = classes.filter(F.col("length") == length)
        visiting = pin(visits(alike, choose_pivots(alike, most_pivots), cosine), "visits")
        links = tile_links(tile_pairs(visiting, tile), cosine)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "rep bigint, n bigint, other bigint")
    found = pin(found, "links")
    counts = found.filter("other is null").groupBy("rep").agg(F.sum("n").alias("n"))
    links = found.filter("other is not null").selectExpr("rep as a", "other as b")
    components = connected_components(links.unionByName(same_id_links(rows.filter("vector is not null"), classes)))
    known = classes.select("vector", "rep", "m").join(counts, "rep", "left")
    known = known.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select(
        "vector",
        (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    component = F.coalesce("component_id", "id")
    return rows.join(known, "vector", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
