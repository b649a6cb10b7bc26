"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

1. Split points are chosen, far apart, from a sample of at most ``SAMPLE`` rows
   (rows of the smallest hashes, at most ``SAMPLE_BYTES``): a node has up to ``FANOUT`` of them and
   a row belongs to the nearest.  Nodes are split while they are expected to
   hold over ``LEAF_ROWS`` rows and are fewer than ``LEVELS`` deep.  The sample
   shapes the tree only; every row is indexed.
2. All rows are sent down the tree and written in order of their leaf, dealt by
   (leaf, hash) in ranges of equal row counts, so a leaf that holds a third of
   all rows (copies of one vector) is many partitions.  Every node keeps, for
   each split point, the least and greatest distance to the rows of each
   sibling subtree; leaves keep the range of their norms.
3. Anchors are taken in blocks of at most ``ANCHORS`` rows, broadcast, and each
   task goes through the leaves of its partition.  A window of scores and the
   norms of a leaf bound an anchor's distance to the rows it looks for: an
   annulus.  A subtree is passed over when, for some split point, no distance
   in its range can belong to a row of the annulus; the rows of the leaves that
   remain are scored exactly, by one product of integers held in float64.
4. Positives: the anchor's own leaf gives a lower bound for the fifth best
   score, then all leaves are searched for scores from there.  Negatives: the
   windows of an anchor's positives are searched together.  Each task hands over
   the few best rows per anchor, ranked in two steps.  The result is exact.

Defined cases: rows with a null vec_id, label or vector, or a null or
non-finite component, take no part; a shorter vector is filled with zeros (an
empty one is all zeros); rows that repeat a vec_id are different rows, ties
among them fall in any order; scores are computed exactly, beyond 64 bits they
count as the nearest 64-bit integer; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenledger.llm.common import prepare, spread_rows, written

POSITIVES = 5
NEGATIVES = 3
#: Hundredths of the positive's score between which a negative's lies.
LOW, HIGH = 50, 95
ANCHOR_EVERY = 50

SAMPLE = 20_000
SAMPLE_BYTES = 32 << 20
FANOUT = 16
LEAF_ROWS = 512
LEVELS = 3
ROWS_PER_FILE = 16_384
ANCHORS = 2_048
ANCHOR_BYTES = 16 << 20
#: Rows scored by one product.
TILE = 2_048
TASKS = 256
EXACT = 1 << 53
_LONG = (1 << 63) - 1


# ------------------------------------------------------------------- the tree

@dataclass
class Node:
    points: np.ndarray  # split points, one a row
    children: list[int]  # node index, or -1 - leaf


class Tree:
    """Split points from a sample; ``leaf`` 0 is all there is in a tree without nodes."""

    def __init__(self, sample: np.ndarray, rows: int, fanout: int | None = None, leaf_rows: int | None = None):
        self.nodes: list[Node] = []
        self.paths: list[list[tuple[int, int]]] = []  # of a leaf: (node, branch) from the root
        self.fanout, self.leaf_rows = fanout or FANOUT, leaf_rows or LEAF_ROWS
        self._grow(sample, rows / max(1, len(sample)), [])

    def _grow(self, x: np.ndarray, scale: float, path: list[tuple[int, int]]) -> int:
        points = self._far_apart(x) if len(x) * scale > self.leaf_rows and len(path) < LEVELS else x[:0]
        if len(points) < 2:
            self.paths.append(path)
            return -len(self.paths)
        node = Node(points, [])
        me = len(self.nodes)
        self.nodes.append(node)
        near = np.argmin(distances(x, points), axis=1)
        for j in range(len(points)):
            node.children.append(self._grow(x[near == j], scale, [*path, (me, j)]))
        return me

    def _far_apart(self, x: np.ndarray) -> np.ndarray:
        """Up to ``fanout`` different rows: each the farthest, of some
        candidates, from those taken before."""
        pool = x[:8 * self.fanout]
        taken = [0]
        gap = distances(pool, pool[:1])[:, 0]
        while len(taken) < self.fanout:
            k = int(np.argmax(gap))
            if not gap[k] > 0:
                break
            taken.append(k)
            gap = np.minimum(gap, distances(pool, pool[k:k + 1])[:, 0])
        return pool[taken]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            k, rows = todo.pop()
            node = self.nodes[k]
            near = np.argmin(distances(x[rows], node.points), axis=1)
            for j, child in enumerate(node.children):
                part = rows[near == j]
                if len(part) and child < 0:
                    out[part] = -1 - child
                elif len(part):
                    todo.append((child, part))
        return out


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows of ``x`` by rows of ``points``."""
    with np.errstate(over="ignore", invalid="ignore"):
        square = (x * x).sum(1)[:, None] - 2 * (x @ points.T) + (points * points).sum(1)
        return np.sqrt(np.maximum(square, 0))


# ------------------------------------------------------------------- the index

@dataclass
class Index:
    rows: DataFrame  # (rid, vec_id, label, leaf, vec), in order of the leaf
    tree: Tree
    ranges: dict  # (node, branch) -> (least, greatest distance) by split point
    norms: dict  # leaf -> (least, greatest squared norm)
    dim: int


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled with zeros."""
    off = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(off)
    if len(sizes) and (sizes == dim).all():
        return values[off[0]:off[-1]].reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes]) if len(sizes) else []] = values[off[0]:off[-1]]
    return out


def _leaf_tiles(batches, dim: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(leaf, rid, vec_id, label, vectors)`` of neighbouring rows of a leaf."""
    for b in batches:
        rid, vec, label, leaf = (b.column(i).to_numpy() for i in range(4))
        cut = np.flatnonzero(np.diff(leaf)) + 1
        for a, z in zip([0, *cut], [*cut, len(leaf)]):
            for x in range(a, z, TILE):
                y = min(x + TILE, z)
                yield int(leaf[x]), rid[x:y], vec[x:y], label[x:y], _matrix(b.column(4).slice(x, y - x), dim)


def taking_part(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, vec)``: rows that take part, labels as mined, whole
    numbers as components."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: x.cast("double") * 256)
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), whole.alias("vec"))


def build_index(vectors: DataFrame, fanout: int | None = None, leaf_rows: int | None = None) -> Index | None:
    """The index of all rows of ``(vec_id, label, vec)``; None without rows."""
    sc = vectors.sparkSession.sparkContext
    src = written(vectors, "vectors")
    st = src.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    n, dim = int(st["n"]), max(1, int(st["dim"] or 0))
    if not n:
        return None
    some = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * dim)))
    sample = src.orderBy(F.xxhash64("vec_id"), "vec_id").limit(some).select("vec").toArrow()["vec"].combine_chunks()
    sample = np.floor(_matrix(sample, dim))
    tree = Tree(sample, n, fanout, leaf_rows)
    shared = sc.broadcast(tree)

    def place(batches):
        for b in batches:
            x = np.floor(_matrix(b.column(2), dim))
            vec = pa.ListArray.from_arrays(np.arange(0, (len(x) + 1) * dim, dim, dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared.value.leaves(x)), vec],
                                             ["vec_id", "label", "leaf", "vec"])

    placed = spread_rows(src).mapInArrow(place, "vec_id bigint, label bigint, leaf bigint, vec array<double>")
    files = max(1, -(-n // ROWS_PER_FILE))
    rows = written(placed.withColumn("salt", F.xxhash64("vec_id", "vec")).repartitionByRange(files, "leaf", "salt")
                   .sortWithinPartitions("leaf").select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "leaf", "vec"),
                   "vector-index")

    def measure(batches):
        tree = shared.value
        out: dict = {}
        for leaf, _, _, _, x in _leaf_tiles(batches, dim):
            for node, branch in tree.paths[leaf]:
                d = distances(x, tree.nodes[node].points)
                for i, (lo, hi) in enumerate(zip(d.min(0), d.max(0))):
                    a, b = out.get((node, branch, i), (lo, hi))
                    out[node, branch, i] = min(a, lo), max(b, hi)
            with np.errstate(over="ignore"):
                s = (x * x).sum(1)
            a, b = out.get((-1, leaf, 0), (s.min(), s.max()))
            out[-1, leaf, 0] = min(a, s.min()), max(b, s.max())
        if out:
            keys, vals = np.array(list(out)), np.array(list(out.values()))
            yield pa.RecordBatch.from_arrays([*(pa.array(keys[:, i]) for i in range(3)), *(pa.array(vals[:, i]) for i in range(2))],
                                             ["node", "branch", "point", "lo", "hi"])

    found = rows.mapInArrow(measure, "node bigint, branch bigint, point bigint, lo double, hi double").groupBy(
        "node", "branch", "point").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow().to_pydict()
    ranges, norms = {}, {}
    for node, branch, point, lo, hi in zip(*(found[c] for c in ("node", "branch", "point", "lo", "hi"))):
        if node < 0:
            norms[branch] = (lo, hi)
        else:
            at = ranges.setdefault((node, branch), np.zeros((2, len(tree.nodes[node].points))))
            at[:, point] = lo, hi
    return Index(rows, tree, ranges, norms, dim)


# ------------------------------------------------------------------ the search

class Probe:
    """A block of anchors in one task: which leaves concern them, and scores."""

    def __init__(self, x: np.ndarray, tree: Tree, ranges: dict, norms: dict):
        self.x, self.tree, self.ranges, self.norms = x, tree, ranges, norms
        with np.errstate(over="ignore"):
            self.square = (x * x).sum(1)
        self.norm = np.sqrt(self.square)
        self.top = float(np.abs(x).max(initial=0))
        self._far: dict[int, np.ndarray] = {}

    def concerned(self, leaf: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Anchors with a possible row of score ``low`` to ``high`` in the leaf."""
        least, most = self.norms[leaf]
        with np.errstate(invalid="ignore", over="ignore"):
            outer2 = self.square + most - 2 * low
            outer = np.sqrt(np.maximum(outer2, 0))
            inner = np.sqrt(np.maximum(self.square + least - 2 * high, 0))
            slack = 1e-6 * (1 + self.norm + np.sqrt(most))
            gone = (outer2 < -1e-6 * (1 + self.square + most)) | (low > high)
            for node, branch in self.tree.paths[leaf]:
                points = self.tree.nodes[node].points
                if node not in self._far:
                    self._far[node] = distances(self.x, points)
                far = self._far[node]
                lo, hi = self.ranges[node, branch]
                spare = (slack + 1e-6 * np.sqrt((points * points).sum(1).max()))[:, None]
                gone |= ((lo > far + outer[:, None] + spare) | (hi < far - outer[:, None] - spare)
                         | (hi + far < inner[:, None] - spare)).any(1)
        return np.flatnonzero(~gone)

    def scores(self, which: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact inner products; Python integers where float64 could round."""
        if self.top * float(np.abs(x).max(initial=0)) * x.shape[1] * 100 < EXACT:
            return (self.x[which] @ x.T).astype(np.int64)
        whole = lambda m: np.array([[int(v) for v in r] for r in m], dtype=object)
        return np.minimum(np.maximum(whole(self.x[which]).dot(whole(x.T)), -_LONG - 1), _LONG)


class Best:
    """The ``k`` best rows of each slot: score descending, vec_id ascending."""

    def __init__(self, slots: int, k: int):
        self.k, self.kept = k, [[] for _ in range(slots)]
        #: the score that a row must reach to count
        self.worst = np.full(slots, -_LONG - 1, dtype=np.int64)

    def full(self, slot: int) -> bool:
        return len(self.kept[slot]) == self.k

    def add(self, slots: np.ndarray, wanted: np.ndarray, score: np.ndarray, rid: np.ndarray, vec_id: np.ndarray) -> None:
        """Rows (columns of ``wanted`` and ``score``) for each slot (a row there)."""
        line, col = np.nonzero(wanted)
        for i in np.unique(line):
            c, slot = col[line == i], int(slots[i])
            fresh = zip((-score[i, c]).tolist(), vec_id[c].tolist(), rid[c].tolist())
            rows = sorted([*self.kept[slot], *fresh])[:self.k]
            self.kept[slot] = rows
            if len(rows) == self.k:
                self.worst[slot] = -rows[-1][0]

    def batch(self, width: int):
        """Rows ``(anchor, positive, tasks, rid, vec_id, score)``; a slot is
        anchor * width + positive."""
        out = [(s // width, s % width, r, v, -n) for s, rows in enumerate(self.kept) for n, v, r in rows]
        if not out:
            return
        anchor, positive, rid, vec_id, score = zip(*out)
        group = TaskContext.get().partitionId() // TASKS
        yield pa.RecordBatch.from_arrays([
            pa.array(anchor, pa.int32()), pa.array(positive, pa.int32()), pa.array([group] * len(out), pa.int32()),
            pa.array(rid, pa.int64()), pa.array(vec_id, pa.int64()), pa.array(score, pa.int64())], _FOUND.names)


class _FOUND:
    names = ["anchor", "positive", "tasks", "rid", "vec_id", "score"]
    schema = "anchor int, positive int, tasks int, rid bigint, vec_id bigint, score bigint"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.asc("vec_id"), F.asc("rid")]
    near = found.withColumn("_r", F.row_number().over(
        Window.partitionBy("anchor", "positive", "tasks").orderBy(*order))).where(F.col("_r") <= k)
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("anchor", "positive", "rank", "rid", "vec_id", "score")


def _blocks(anchors: DataFrame, dim: int) -> Iterator[dict]:
    size = min(ANCHORS, max(1, ANCHOR_BYTES // (8 * dim)))
    rows = []
    for r in anchors.toLocalIterator():
        rows.append(r)
        if len(rows) == size:
            yield _block(rows, dim)
            rows = []
    if rows:
        yield _block(rows, dim)


def _block(rows: list, dim: int) -> dict:
    x = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        x[i, :len(r["vec"])] = r["vec"]
    return {"x": x} | {c: np.array([r[c] for r in rows], dtype=np.int64) for c in ("rid", "vec_id", "label", "leaf")}


def _positives(index: Index, shared, block, low: np.ndarray | None, k: int) -> DataFrame:
    """The ``k`` best rows of each anchor's label: in the anchor's own leaf
    (``low`` is None), or in all leaves, with scores of ``low`` or more."""
    dim = index.dim

    def run(batches):
        tree, ranges, norms = shared.value
        anchors = block.value
        probe, best = Probe(anchors["x"], tree, ranges, norms), Best(len(anchors["x"]), k)
        bound = None if low is None else low.copy()
        top = np.full(len(anchors["x"]), np.inf)
        for leaf, rid, vec_id, label, x in _leaf_tiles(batches, dim):
            which = np.flatnonzero(anchors["leaf"] == leaf) if bound is None else probe.concerned(leaf, bound, top)
            which = which[np.isin(anchors["label"][which], label)]
            if not len(which):
                continue
            s = probe.scores(which, x)
            mine = (anchors["label"][which][:, None] == label) & (anchors["rid"][which][:, None] != rid)
            best.add(which, mine & (s >= best.worst[which][:, None]), s, rid, vec_id)
            if bound is not None:
                done = [a for a in which if best.full(a)]
                bound[done] = np.maximum(bound[done], best.worst[done])
        yield from best.batch(1)

    return _ranked(index.rows.mapInArrow(run, _FOUND.schema), k)


def _negatives(index: Index, shared, block, scores: np.ndarray, given: np.ndarray, k: int) -> DataFrame:
    """For every anchor and positive (score ``scores[a, p]`` where ``given``)
    the ``k`` best rows of other labels inside the positive's window."""
    dim, width = index.dim, scores.shape[1]

    def run(batches):
        tree, ranges, norms = shared.value
        anchors = block.value
        probe, best = Probe(anchors["x"], tree, ranges, norms), Best(scores.size, k)
        floor = np.where(given, scores * (LOW / 100), np.inf)
        low = floor.min(1, initial=np.inf)
        high = np.where(given, scores * (HIGH / 100), -np.inf).max(1, initial=-np.inf)
        goal = scores if np.abs(scores.astype(float)).max(initial=0) < EXACT else scores.astype(object)
        wide = 1e-9 * (1 + np.abs(np.where(given, scores, 0)).max(1, initial=0))  # rounding of the bounds alone
        for leaf, rid, vec_id, label, x in _leaf_tiles(batches, dim):
            which = probe.concerned(leaf, low - wide, high + wide)
            if not len(which):
                continue
            s = probe.scores(which, x)
            hundred = np.where(anchors["label"][which][:, None] != label, s * 100, -1)  # no window has negative scores
            for p in range(width):
                own = given[which, p]
                at, slots = which[own], which[own] * width + p
                pos = goal[at, p][:, None]
                inside = (hundred[own] >= np.maximum(LOW * pos, 0)) & (hundred[own] <= HIGH * pos) & (s[own] >= best.worst[slots][:, None])
                best.add(slots, inside, s[own], rid, vec_id)
            low[which] = np.maximum(floor, best.worst.reshape(scores.shape))[which].min(1)
        yield from best.batch(width)

    return _ranked(index.rows.mapInArrow(run, _FOUND.schema), k)


SCHEMA = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   fanout: int | None = None, leaf_rows: int | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for every row whose vec_id is divisible by ``ANCHOR_EVERY``."""
    spark = vectors.sparkSession
    prepare(vectors)
    index = build_index(taking_part(vectors), fanout, leaf_rows)
    results = []
    if index is not None:
        shared = spark.sparkContext.broadcast((index.tree, index.ranges, index.norms))
        for anchors in _blocks(index.rows.where(F.col("vec_id") % ANCHOR_EVERY == 0), index.dim):
            results.append(_mine(index, shared, anchors, positives, negatives))
    return reduce(DataFrame.unionAll, results) if results else spark.createDataFrame([], SCHEMA)


def _mine(index: Index, shared, anchors: dict, positives: int, negatives: int) -> DataFrame:
    spark, n = index.rows.sparkSession, len(anchors["x"])
    block = spark.sparkContext.broadcast(anchors)
    low = np.full(n, -np.inf)
    for r in _positives(index, shared, block, None, positives).where(F.col("rank") == positives).collect():
        low[r["anchor"]] = r["score"]
    scores, given = np.zeros((n, positives), dtype=np.int64), np.zeros((n, positives), dtype=bool)
    rows = []
    for r in _positives(index, shared, block, low, positives).collect():
        a, p = r["anchor"], r["rank"] - 1
        scores[a, p], given[a, p] = r["score"], True
        rows.append((a, p, int(anchors["vec_id"][a]), r["vec_id"], r["score"]))
    names = spark.createDataFrame(rows, "anchor int, positive int, anchor_id bigint, positive_id bigint, positive_score bigint")
    found = _negatives(index, shared, block, scores, given, negatives)
    # one row per anchor of the block and positive: bounded by ANCHORS
    out = found.join(F.broadcast(names), ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    return written(out, "hard-negatives")
