"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

1. Components become integers, ``floor(scale * x)``.  A Hilbert curve through the dimensions that vary most orders the
   rows of each label; the range-sorted table is cut into blocks and written as Parquet, one row a block:
   its vectors, and a zone map, the least and greatest value of every dimension.
2. Interval arithmetic over a zone map bounds the inner products of an anchor with all vectors of the block, from above
   and below.  Bounds need the narrow columns of the block table only.
3. The block an anchor lies in gives a score that its last positive must reach.  The blocks of its label whose upper bound
   reaches it are read; the best ``positives`` other rows of the label are the anchor's positives.
4. Each positive opens a window of scores, from ``low`` to ``high`` percent of its own.  The blocks of other labels whose bounds meet
   a window of the anchor are read, and the best ``negatives`` rows inside each window are returned.

Anchors and blocks meet in cells: both are dealt by a hash, so a cell holds a bounded number of either, and cells plan
first, on zone maps alone; only blocks and anchors that the plan names travel to the cell that reads them.

Scores are exact: products run in doubles where no sum can pass 2**53, else in 64-bit or unbounded integers (then a score is
clipped to 64 bits).  Higher scores come first, ties by smaller id.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part; rows that repeat an
id count once, by the smallest (label, vector); vectors meet only vectors of their own length; equal
vectors with other ids are other rows; an anchor with fewer rows than asked has all it has; an empty window gives
no row; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardsmith.llm.common import prepare, shuffle_partitions
from boardsmith.session import materialize

BLOCK_ROWS = 512
RANGE_ROWS = 100_000  # rows of one range of the sorted table
CELL_ROWS, CELL_ANCHORS = 16_384, 2_048  # at most about so many rows and anchors meet in one cell
AXES, BITS = 8, 7  # dimensions that the curve runs through, and bits of each

Wide = np.int64


# ------------------------------------------------------------------------------------------------------ curve

def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with ``bits`` bits in each coordinate (rows of ``cells``), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess rotations and reflections, from the coarsest bit on
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _keyed(axes: list[tuple[int, float, float]]):
    """Adds the place on the curve through ``axes``: (dimension, mean, deviation)."""

    def run(batches):
        for b in batches:
            vectors = b.column("vec")
            values, at = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            sizes = np.diff(at)
            cells = np.zeros((b.num_rows, len(axes)), np.int64)
            for k, (dim, mean, spread) in enumerate(axes):
                has = sizes > dim
                own = np.zeros(b.num_rows)
                own[has] = values[at[:-1][has] + dim]
                cells[:, k] = np.clip((own - mean + 2 * spread) / (4 * spread or 1.0) * (1 << BITS), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert(cells, BITS) if axes else np.zeros(b.num_rows, np.int64))], [*b.schema.names, "key"])

    return run


# ----------------------------------------------------------------------------------------------------- blocks

BLOCKS = "block bigint, dim int, label string, n int, lo array<bigint>, hi array<bigint>, ids binary, vecs binary"


def _packed(batches):
    """Consecutive rows of one label and length to block rows with their zone maps."""
    place = TaskContext.get().partitionId() << 32
    held: list[tuple] = []

    def block(number):
        rows = sorted(held, key=lambda r: r[0])
        dim, label = held_kind
        m = np.stack([v for _, v in rows]).reshape(len(rows), dim)
        return {"block": place | number, "dim": dim, "label": label, "n": len(rows), "lo": m.min(0).tolist(), "hi": m.max(0).tolist(),
                "ids": np.array([i for i, _ in rows], Wide).tobytes(), "vecs": m.tobytes()}

    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("label", pa.string()), ("n", pa.int32()), ("lo", pa.list_(pa.int64())),
                        ("hi", pa.list_(pa.int64())), ("ids", pa.binary()), ("vecs", pa.binary())])
    number, held_kind = 0, None
    for b in batches:
        out = []
        vectors = b.column("vec")
        values, at = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
        for vec_id, label, dim, start in zip(*[b.column(c).to_pylist() for c in ("vec_id", "label", "dim")], at[:-1].tolist(), strict=True):
            if held and (held_kind != (dim, label) or len(held) == BLOCK_ROWS):
                out.append(block(number))
                number, held = number + 1, []
            held_kind = (dim, label)
            held.append((vec_id, values[start:start + dim]))
        yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist([block(number)], schema)


def usable(rows: DataFrame, scale: int, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """(vec_id, label, vec, dim) of the rows that take part, one for each id."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    v = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"), x.alias("x"))
    v = v.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    v = v.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    v = v.select("vec_id", F.struct("label", F.transform("x", lambda c: F.floor(c * scale)).alias("vec")).alias("row"))
    return v.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vec", F.size("row.vec").alias("dim"))


def block_table(rows: DataFrame) -> DataFrame:
    """The written block table of ``usable`` rows."""
    rows = materialize(rows, "integer-vectors")
    spread = rows.select(F.posexplode("vec").alias("dim", "x")).groupBy("dim").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"))
    axes = [tuple(r) for r in spread.orderBy(F.desc("spread"), "dim").limit(AXES).collect()]
    n = rows.count()
    keyed = rows.mapInArrow(_keyed(axes), "vec_id bigint, label string, vec array<bigint>, dim int, key bigint")
    order = ["dim", "label", "key", "vec_id"]
    ranges = max(1, -(-n // RANGE_ROWS))
    ordered = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return materialize(ordered.mapInArrow(_packed, BLOCKS), "hilbert-blocks")  # ranges are sampled: all that follows reads the written blocks


# ------------------------------------------------------------------------------------------------------ cells

def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices, exact (clipped to 64 bits)."""
    most = lambda m: max(int(m.max()), -int(m.min())) if m.size else 0
    bound = most(a) * most(b) * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(Wide)
    if bound < 1 << 63:
        return a @ b.T
    top = (1 << 63) - 1
    return np.clip(a.astype(object) @ b.T.astype(object), -top, top).astype(Wide)


def interval_bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of each anchor with any vector inside each box, widened by the rounding of doubles."""
    a, lo, hi = anchors.astype(np.float64), lo.astype(np.float64).T, hi.astype(np.float64).T
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1e-12 * (np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)))
    return up @ lo + down @ hi - slack, up @ hi + down @ lo + slack


OUT_OF_PLAY = np.iinfo(np.int64).min


def best(scores: np.ndarray, k: int):
    """(row, column) pairs of the k greatest of each row in play, in falling order; columns come by rising id, so ties go to the smaller."""
    s = scores.copy()
    every = np.arange(len(s))
    for _ in range(min(k, s.shape[1])):
        at = s.argmax(1)
        live = s[every, at] > OUT_OF_PLAY
        yield every[live], at[live]
        s[every[live], at[live]] = OUT_OF_PLAY


def windows(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores n with ``low * p <= 100 * n <= high * p``, as (least, greatest)."""
    whole = positive.astype(object)
    return (-(-whole * low // 100)).astype(Wide), (whole * high // 100).astype(Wide)


ANCHORS = "anchor_id bigint, label string, dim int, vec binary, block bigint, scores array<bigint>"


def _seeded(k: int, is_anchor):
    """The anchors of each block, with the scores of their best k rows inside it."""

    def run(batches):
        for b in batches:
            out = []
            for block, dim, label, ids, vecs in zip(*[b.column(c).to_pylist() for c in ("block", "dim", "label", "ids", "vecs")], strict=True):
                ids = np.frombuffer(ids, Wide)
                m = np.frombuffer(vecs, Wide).reshape(len(ids), dim)
                own = np.flatnonzero(is_anchor(ids))
                if not len(own):
                    continue
                s = products(m[own], m)
                s[np.arange(len(own)), own] = OUT_OF_PLAY
                found: list[list[int]] = [[] for _ in own]
                for rows, at in best(s, k):
                    for r, c in zip(rows, at, strict=True):
                        found[r].append(int(s[r, c]))
                out += [{"anchor_id": int(ids[o]), "label": label, "dim": dim, "vec": m[o].tobytes(), "block": block, "scores": f}
                        for o, f in zip(own, found, strict=True)]
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("anchor_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("vec", pa.binary()), ("block", pa.int64()), ("scores", pa.list_(pa.int64()))]))

    return run


class Search:
    """What anchors look for in blocks: rows of their label (positives) or of others, inside their windows (negatives)."""

    def __init__(self, same_label: bool, k: int, low: int = 0, high: int = 0):
        self.same_label, self.k, self.low, self.high = same_label, k, low, high

    def windows(self, scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) score of each window of each anchor; a row's missing windows are empty."""
        if self.same_label:  # one window: as good as the k-th in the anchor's own block
            least = [s[self.k - 1] if len(s) >= self.k else OUT_OF_PLAY + 1 for s in scores]
            return np.array(least, Wide)[:, None], np.full((len(scores), 1), np.iinfo(np.int64).max)
        most = max(map(len, scores), default=0)
        lo, hi = np.ones((len(scores), most), Wide), np.zeros((len(scores), most), Wide)
        for i, s in enumerate(scores):
            lo[i, :len(s)], hi[i, :len(s)] = windows(np.asarray(s, Wide), self.low, self.high)
        return lo, hi


class Cell:
    """The anchors of one cell."""

    def __init__(self, search: Search, anchors: pd.DataFrame):
        self.search, self.dim = search, int(anchors["dim"].iloc[0])
        self.ids, self.labels = anchors["anchor_id"].to_numpy(np.int64), anchors["label"].to_numpy()
        self.vectors = np.frombuffer(b"".join(anchors["vec"]), Wide).reshape(len(anchors), self.dim)
        self.lo, self.hi = search.windows(list(anchors["scores"]))

    def wanted(self, blocks: pd.DataFrame) -> np.ndarray:
        """Which anchors must read which blocks, by the zone maps."""
        box = [np.stack([np.asarray(v, Wide) for v in blocks[c]]).reshape(len(blocks), self.dim) for c in ("lo", "hi")]
        low, high = interval_bounds(self.vectors, *box)
        out = np.zeros(low.shape, bool)
        for lo, hi in zip(self.lo.T, self.hi.T, strict=True):
            least, most = lo.astype(np.float64)[:, None], hi.astype(np.float64)[:, None]
            out |= (lo <= hi)[:, None] & (high >= least - 1e-12 * np.abs(least)) & (low <= most + 1e-12 * np.abs(most))
        return out & ((self.labels[:, None] == blocks["label"].to_numpy()[None, :]) == self.search.same_label)

    def read(self, block, rows: np.ndarray):
        """(anchor rows, window, ids, scores) found in one block by the anchors ``rows``."""
        ids = np.frombuffer(block.ids, Wide)
        s = products(self.vectors[rows], np.frombuffer(block.vecs, Wide).reshape(len(ids), self.dim))
        s[self.ids[rows][:, None] == ids[None, :]] = OUT_OF_PLAY
        for w, (lo, hi) in enumerate(zip(self.lo[rows].T, self.hi[rows].T, strict=True)):
            part = np.where((s >= lo[:, None]) & (s <= hi[:, None]), s, OUT_OF_PLAY)
            for r, c in best(part, self.search.k):
                yield rows[r], w, ids[c], part[r, c]


def _plan(search: Search):
    def run(anchors: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"cell": [], "part": [], "anchor": [], "id": []}).astype({"cell": "int32", "part": "int32", "anchor": "bool", "id": "int64"})]
        if len(anchors) and len(blocks):
            cell = Cell(search, anchors)
            wanted = cell.wanted(blocks)
            place = {"cell": np.int32(anchors["cell"].iloc[0]), "part": np.int32(anchors["part"].iloc[0])}
            out += [pd.DataFrame({**place, "anchor": True, "id": cell.ids[wanted.any(1)]}), pd.DataFrame({**place, "anchor": False, "id": blocks["block"].to_numpy()[wanted.any(0)]})]
        return pd.concat(out)

    return run


FOUND = "anchor_id bigint, place int, vec_id bigint, score bigint"


def _read(search: Search):
    def run(anchors: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"anchor_id": [], "place": [], "vec_id": [], "score": []}).astype({"anchor_id": "int64", "place": "int32", "vec_id": "int64", "score": "int64"})]
        if len(anchors) and len(blocks):
            cell = Cell(search, anchors)
            wanted = cell.wanted(blocks)
            for k, block in enumerate(blocks.itertuples(index=False)):
                rows = np.flatnonzero(wanted[:, k])
                if len(rows):
                    found += [pd.DataFrame({"anchor_id": cell.ids[r], "place": np.int32(w), "vec_id": ids, "score": s}) for r, w, ids, s in cell.read(block, rows)]
        # The cell's own best are enough: those of all cells are ranked together.
        out = pd.concat(found).sort_values(["anchor_id", "place", "score", "vec_id"], ascending=[True, True, False, True])
        return out.groupby(["anchor_id", "place"]).head(search.k)

    return run


def _run(search: Search, anchors: DataFrame, blocks: DataFrame, parts: int, cells: int) -> DataFrame:
    """(anchor_id, place, vec_id, score, rank): the best of each anchor and window over all blocks that its bounds admit."""
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("part", deal("anchor_id", parts))
    b = blocks.withColumn("cell", deal("block", cells))
    zones = b.select("block", "dim", "label", "lo", "hi", "cell")
    plan = a.withColumn("cell", every(cells)).groupBy("dim", "cell", "part").cogroup(
        zones.withColumn("part", every(parts)).groupBy("dim", "cell", "part")).applyInPandas(_plan(search), "cell int, part int, anchor boolean, id bigint")
    plan = materialize(plan, "read-plan")
    asked = plan.where("anchor").select("cell", F.col("id").alias("anchor_id")).join(a, "anchor_id")
    read = plan.where("NOT anchor").select("part", F.col("id").alias("block")).join(b, "block")
    found = asked.groupBy("dim", "cell", "part").cogroup(read.groupBy("dim", "cell", "part")).applyInPandas(_read(search), FOUND)
    w = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= search.k)


def every_nth(n: int):
    return lambda ids: ids % n == 0


def mine(rows: DataFrame, is_anchor=every_nth(50), positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
         id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``is_anchor`` (over arrays of ids) names."""
    spark = rows.sparkSession
    prepare(spark)
    blocks = block_table(usable(rows, scale, id_col, label_col, vec_col))
    seeds = materialize(blocks.mapInArrow(_seeded(positives, is_anchor), ANCHORS), "anchors")
    n_rows, n_blocks = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-seeds.count() // CELL_ANCHORS))
    cells = max(1, -(-n_rows // CELL_ROWS), min(n_blocks, -(-shuffle_partitions(spark) // parts)))
    anchors = seeds.select("anchor_id", "label", "dim", "vec", "scores")
    top = materialize(_run(Search(True, positives), anchors, blocks, parts, cells).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("at")), "positives")
    own = top.groupBy("anchor_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "positive_score"))), lambda p: p["positive_score"]).alias("scores"))
    asking = materialize(anchors.drop("scores").join(own, "anchor_id"), "windows")
    found = _run(Search(False, negatives, low, high), asking, blocks, parts, cells)
    return found.join(top.withColumn("place", F.col("at") - 1), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(label: Column, vec_id: Column, every: int = 7, classes: int = 10) -> Column:
    """``(label + 1) % classes`` where ``every`` divides the id, else the label."""
    return F.when(vec_id % every == 0, (label + 1) % classes).otherwise(label)
