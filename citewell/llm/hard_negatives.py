"""Hard-negative mining over candidate blocks in Hilbert-curve order with zone maps.

Vectors are quantised to integers, ordered by label and place on a Hilbert curve, and written as a
Parquet table of blocks: runs of rows of one label with each dimension's least and greatest value.
For an anchor, interval arithmetic over these values bounds every score a block can
hold.  A search asks for the best rows whose scores lie in the anchor's windows, and reads a block
only if its label fits and its bounds meet a window.

Each search reads twice: first the blocks with the highest bounds, then, with
windows that begin at what was found there, all other blocks that may hold better rows.  Anchors are taken
in runs of the same curve, so those of a run want similar blocks.  Both sides of a
read are dealt into tiles of bounded size: one run of anchors and a few blocks.  Vectors without any
cluster structure have wide zones; then few blocks are spared, and what is left is an exact
blockwise search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.operators.rowindex import with_row_index
from citewell.session import staged

#: Positives of an anchor, negatives of a positive, and the window of negative scores in hundredths of the positive's.
POSITIVES, NEGATIVES, WINDOW = 5, 10, (30, 90)
#: Factor of the quantisation.
SCALE = 256
#: Rows of a block, blocks of a tile, zone maps of a tile, and components of a run of anchors.
BLOCK, TILE, ZONES, RUN = 256, 32, 4096, 1 << 18
#: Blocks of highest bound that are read first, for each anchor.
NEAR = 2
#: Bits of a dimension on the curve.
BITS = 4

# Scores and components beyond these count as these.
_FAR, _LARGE = 1 << 61, 1 << 53
_NONE = -(1 << 62)
_CODED = "id bigint, label bigint, anchor boolean, curve binary, point binary"
_BLOCKS = "block bigint, label bigint, ids binary, anchors binary, points binary, low binary, high binary"
_ANCHORS = "block bigint, place int, id bigint, label bigint, point binary"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer tables."""
    most = [int(np.abs(x).max(initial=0)) for x in (a, b)]
    if a.shape[1] * most[0] * most[1] < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return np.clip(a.astype(object) @ b.T.astype(object), -_FAR, _FAR).astype(np.int64)


def bounds(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each point with anything between ``low`` and ``high``, by interval arithmetic."""
    up, down = np.maximum(points, 0), np.minimum(points, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def hilbert(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Places on a Hilbert curve of rows of cell numbers: Skilling's transform, all rows at a time."""
    axes = cells.T.astype(np.uint16).copy()
    one = np.uint16(1 << (bits - 1))
    while one > 1:
        low = np.uint16(one - 1)
        for axis in axes:
            turned = (axis & one) != 0
            swap = np.where(turned, np.uint16(0), (axes[0] ^ axis) & low)
            axes[0] ^= np.where(turned, low, swap)
            axis ^= swap
        one >>= np.uint16(1)
    axes[:] = np.bitwise_xor.accumulate(axes, axis=0)
    flip = np.zeros(axes.shape[1], np.uint16)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] >> np.uint16(bit) & 1, np.uint16((1 << bit) - 1), np.uint16(0))
    axes ^= flip
    planes = [(axes >> np.uint16(bit) & 1).astype(np.uint8) for bit in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.packbits(np.concatenate(planes).T, axis=1)]


def _matrix(vectors: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are whole (no null or non-finite component), and these as quantised rows of one length."""
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(sizes)
    whole = (wrong[ends] == wrong[ends - sizes]) & vectors.is_valid().to_numpy(zero_copy_only=False)
    dims = int(sizes.max(initial=0)) if dims is None else dims
    matrix = np.zeros((len(sizes), dims))
    matrix[np.arange(dims) < sizes[:, None]] = values
    return whole, np.clip(np.floor(SCALE * matrix[whole]), -_LARGE, _LARGE).astype(np.int64)


def _extent(vectors: DataFrame) -> tuple[int, int, int] | None:
    """Longest length, least and greatest quantised component of all whole vectors; three numbers, or none."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, matrix = _matrix(batch.column(0))
            if len(matrix):
                yield pa.RecordBatch.from_pydict({
                    "dims": [matrix.shape[1]], "low": [int(matrix.min(initial=0))], "high": [int(matrix.max(initial=0))],
                })

    found = vectors.select("vector").mapInArrow(of, "dims bigint, low bigint, high bigint").agg(
        F.max("dims").alias("dims"), F.min("low").alias("low"), F.max("high").alias("high")
    ).first()
    return None if found.dims is None else (found.dims, found.low, found.high)


def _packed(values, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


class _Points:
    """How points are kept in binary columns: ``dims`` integers of the least width that holds all."""

    def __init__(self, dims: int, low: int, high: int):
        self.dims, self.low, self.high = dims, low, high
        self.kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)

    def read(self, column: pa.ChunkedArray | pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), self.kind).reshape(-1, self.dims).astype(np.int64)

    def cells(self, matrix: np.ndarray) -> np.ndarray:
        return ((matrix - self.low) * float(1 << BITS) / (self.high - self.low + 1)).astype(np.int64)


def _coded(vectors: DataFrame, points: _Points) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, matrix = _matrix(batch.column("vector"), points.dims)
            kept = batch.filter(pa.array(whole))
            if kept.num_rows:
                yield pa.RecordBatch.from_pydict({
                    "id": kept.column("id"), "label": kept.column("label"), "anchor": kept.column("anchor"),
                    "curve": hilbert(points.cells(matrix)), "point": [row.tobytes() for row in matrix.astype(points.kind)],
                })

    return vectors.select("id", "label", "anchor", "vector").mapInArrow(code, _CODED)


def _blocks(coded: DataFrame, points: _Points) -> DataFrame:
    """The ordered rows, in blocks of one label, as a stage table; rows of a block ascend by id."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []

        def block(rows: list[tuple]) -> tuple:
            rows = sorted(rows)
            matrix = np.frombuffer(b"".join(r[3] for r in rows), points.kind).reshape(len(rows), points.dims)
            return (
                number, rows[0][1], _packed([r[0] for r in rows], "<i8"), _packed([r[2] for r in rows], "<i1"), matrix.tobytes(),
                matrix.min(0).tobytes(), matrix.max(0).tobytes(),
            )

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], [f.split()[0] for f in _BLOCKS.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "anchor", "point"))):
                if waiting and (len(waiting) == BLOCK or waiting[0][1] != row[1]):
                    yield batch_of([block(waiting)])
                    waiting, number = [], number + 1
                waiting.append(row)
        if waiting:
            yield batch_of([block(waiting)])

    ordered = coded.repartitionByRange("label", "curve", "id").sortWithinPartitions("label", "curve", "id")
    return staged(ordered.mapInArrow(pack, _BLOCKS), "candidate-blocks")


def _anchors(blocks: DataFrame, points: _Points) -> DataFrame:
    """row (along the curve), run, id, label and point of every anchor."""
    width = points.dims * np.dtype(points.kind).itemsize

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for block, label, ids, anchors, packed in zip(*(c.to_pylist() for c in batch.columns)):
                numbers = np.frombuffer(ids, "<i8")
                for at in np.flatnonzero(np.frombuffer(anchors, "<i1")).tolist():
                    made.append((block, at, int(numbers[at]), label, packed[at * width : (at + 1) * width]))
            if made:
                columns = [pa.array(v, t) for v, t in zip(zip(*made), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _ANCHORS.split(", ")])

    found = blocks.select("block", "label", "ids", "anchors", "points").mapInArrow(unpack, _ANCHORS)
    numbered = with_row_index(found, ["block", "place"], "row", start=0)
    return numbered.withColumn("run", F.expr(f"`row` div {max(16, RUN // max(points.dims, 1))}"))


class _Run:
    """A tile's anchors: points, labels, ids and windows as arrays."""

    def __init__(self, table: pa.Table, points: _Points):
        self.points = points.read(table["point"])
        self.row, self.id, self.label = (table[c].to_numpy() for c in ("row", "id", "label"))
        windows = table["windows"].combine_chunks()
        ends = windows.flatten()
        self.low, self.high = (ends.field(c).to_numpy().reshape(len(self.row), -1) for c in ("low", "high"))

    def needs(self, table: pa.Table, points: _Points, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and block: whether it must be read, and the greatest score it may hold."""
        least, most = bounds(self.points, points.read(table["low"]), points.read(table["high"]))
        fits = (self.label[:, None] == table["label"].to_numpy()) == same
        meets = np.zeros(fits.shape, bool)
        for low, high in zip(self.low.T, self.high.T):
            meets |= (most >= low[:, None]) & (least <= high[:, None])
        return fits & meets, most


def _asked(anchors: DataFrame, blocks: DataFrame, runs: int, count: int, points: _Points, same: bool, near: bool) -> DataFrame:
    """run, block of all blocks that some anchor of a run must read; with ``near``, of its ``NEAR`` of highest bound."""
    def choose(key, left: pa.Table, right: pa.Table) -> pa.Table:
        chosen = np.zeros(right.num_rows, bool)
        if left.num_rows and right.num_rows:
            needs, most = _Run(left, points).needs(right, points, same)
            if near and right.num_rows > NEAR:
                best = np.argpartition(np.where(needs, -most, _FAR * 2), NEAR, axis=1)[:, :NEAR]
                needs &= np.isin(np.arange(right.num_rows), best)
            chosen = needs.any(0)
        return pa.table({"run": right["run"], "block": right["block"]}).filter(pa.array(chosen))

    zones = blocks.select("block", "label", "low", "high")
    return staged(_tiles(anchors, _for_runs(zones, runs), -(-count // ZONES), choose, "run bigint, block bigint"), "asked-blocks")


def _for_runs(table: DataFrame, runs: int) -> DataFrame:
    return table.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(runs - 1).cast("bigint"))))


def _tiles(anchors: DataFrame, table: DataFrame, slots: int, work, schema: str) -> DataFrame:
    """``work`` over the anchors of a run and one slot of the rows that the run reads."""
    slot = F.pmod(F.xxhash64("block"), F.lit(slots))
    everywhere = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint")))
    left = anchors.withColumn("slot", everywhere).groupBy("run", "slot")
    return left.cogroup(table.withColumn("slot", slot).groupBy("run", "slot")).applyInArrow(work, schema)


def _read(anchors: DataFrame, asked: DataFrame, blocks: DataFrame, count: int, points: _Points, same: bool, k: int) -> DataFrame:
    """row, window, score, id: the best ``k`` rows in each window, of each tile."""
    def best(key, left: pa.Table, right: pa.Table) -> pa.Table:
        made = {c: [] for c in ("row", "window", "score", "id")}
        if left.num_rows and right.num_rows:
            run = _Run(left, points)
            needs, _ = run.needs(right, points, same)
            shape = (*run.low.shape, k)
            scores, ids = np.full(shape, _NONE), np.zeros(shape, np.int64)
            floors = run.low.copy()
            for at, (own, packed) in enumerate(zip(right["ids"].to_pylist(), right["points"].to_pylist())):
                asking = np.flatnonzero(needs[:, at])
                if not len(asking):
                    continue
                own = np.frombuffer(own, "<i8")
                found = products(run.points[asking], points.read(pa.array([packed])))
                found[own == run.id[asking][:, None]] = _NONE
                # Descending by score; the rows' ids ascend, so a stable sort leaves ties in order.
                order = np.argsort(-found, axis=1, kind="stable")
                ranked = np.concatenate([np.take_along_axis(found, order, 1), np.full((len(asking), k), _NONE)], axis=1)
                named = np.concatenate([own[order], np.zeros((len(asking), k), np.int64)], axis=1)
                for w in range(shape[1]):
                    above = (ranked > run.high[asking, w][:, None]).sum(1)
                    places = np.minimum(above[:, None] + np.arange(k), ranked.shape[1] - 1)
                    new = np.take_along_axis(ranked, places, 1)
                    new[new < floors[asking, w][:, None]] = _NONE
                    better = np.flatnonzero(new[:, 0] != _NONE)
                    if not len(better):
                        continue
                    who = asking[better]
                    both = np.concatenate([scores[who, w], new[better]], axis=1)
                    whose = np.concatenate([ids[who, w], np.take_along_axis(named, places, 1)[better]], axis=1)
                    first = np.lexsort((whose, -both), axis=-1)[:, :k]
                    scores[who, w], ids[who, w] = np.take_along_axis(both, first, 1), np.take_along_axis(whose, first, 1)
                    floors[who, w] = np.maximum(floors[who, w], scores[who, w, -1])
            who, window, place = np.nonzero(scores != _NONE)
            made = {"row": run.row[who], "window": window.astype(np.int32), "score": scores[who, window, place], "id": ids[who, window, place]}
        return pa.table({c: pa.array(v, pa.int32() if c == "window" else pa.int64()) for c, v in made.items()})

    rows = asked.join(blocks.drop("anchors"), "block")
    return _tiles(anchors, rows, -(-count // TILE), best, "row bigint, window int, score bigint, id bigint")


def _first(hits: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("row", "window").orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def _search(anchors: DataFrame, blocks: DataFrame, runs: int, count: int, points: _Points, same: bool, k: int) -> DataFrame:
    """row, window, score, id, rank: the best ``k`` rows of each anchor's windows, of its label or of the others."""
    near = _asked(anchors, blocks, runs, count, points, same, near=True)
    found = staged(_first(_read(anchors, near, blocks, count, points, same, k), k), "near-hits")
    floors = found.groupBy("row", "window").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
    listed = floors.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "floor"))).alias("floors"))
    raised = F.transform("windows", lambda w, i: F.struct(
        F.greatest(w["low"], F.coalesce(F.try_element_at("floors", i), w["low"])).alias("low"), w["high"].alias("high")
    ))
    narrowed = staged(anchors.join(listed, "row", "left").withColumn("windows", raised).drop("floors"), "narrowed-anchors")
    rest = _asked(narrowed, blocks, runs, count, points, same, near=False).join(near, ["run", "block"], "left_anti")
    return staged(_first(found.drop("rank").unionByName(_read(narrowed, rest, blocks, count, points, same, k)), k), "hits")


def mined(vectors: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every hard negative.

    Anchors are the rows where ``anchor`` holds.  Rows with a null key, label or vector or a null or non-finite
    component take no part.  Scores are inner products of the components, each as floor(256 * x); a shorter
    vector counts as filled up with zeros, an empty one as zeros alone.  Higher scores come first, ties by smaller key.
    An anchor's positives are its first ``POSITIVES`` rows of its label, and each one's negatives the first
    ``NEGATIVES`` rows of other labels with scores within ``WINDOW`` hundredths of the positive's.  Rows of the anchor's
    own key are never its positives or negatives; repeated rows each count, as anchors as well.  Components
    beyond 2**53 and scores beyond 2**61 count as these.  No anchor, no positive or an empty table gives no rows;
    other columns are left out.
    """
    vectors = vectors.select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("vector"),
    ).where("id is not null and label is not null and vector is not null")
    extent = _extent(vectors)
    empty = vectors.sparkSession.createDataFrame([], _MINED)
    if extent is None:
        return empty
    points = _Points(max(extent[0], 1), *extent[1:])
    blocks = _blocks(_coded(vectors, points), points)
    anchors = _anchors(blocks, points)
    count, last = blocks.count(), anchors.agg(F.max("run")).first()[0]
    if last is None:
        return empty
    runs = last + 1

    anywhere = F.array(F.struct(F.lit(-_FAR).alias("low"), F.lit(_FAR).alias("high")))
    asking = anchors.select("run", "row", "id", "label", "point", anywhere.alias("windows"))
    positives = _search(asking, blocks, runs, count, points, True, POSITIVES)

    score = F.col("score").cast("decimal(20,0)")
    window = F.struct(
        F.ceil(score * WINDOW[0] / 100).cast("bigint").alias("low"), F.floor(score * WINDOW[1] / 100).cast("bigint").alias("high")
    )
    none = F.struct(F.lit(1).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"))
    listed = positives.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("rank", window))).alias("own"))
    windows = F.transform(F.sequence(F.lit(1), F.lit(POSITIVES)), lambda i: F.coalesce(F.try_element_at("own", i), none))
    asking = staged(asking.drop("windows").join(listed, "row").withColumn("windows", windows).drop("own"), "negative-windows")
    negatives = _search(asking, blocks, runs, count, points, False, NEGATIVES)

    pairs = positives.select(
        "row", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    named = negatives.select("row", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(named, ["row", "window"]).select(*[f.split()[0] for f in _MINED.split(", ")])


_MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"

#: The registered query in DuckDB's SQL.
SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
