"""Vector code compression: product codebooks by k-means over metric trees of anchors.

Vectors become integers and are cut into parts; every part position has its own codebook. Each
block of rows holds one metric tree per part position, built once by the anchors hierarchy: about
root n anchors are chosen, each the point furthest from its anchor and taking over the points that
are nearer to it; the anchors' balls are merged pairwise, smallest new ball first, up to the root
(middle-out), and the points of each anchor are treated alike further down. A ball keeps the sum and
the count of its points. A round walks the trees with the list of entries that may own a point of
the ball; a child inherits its parent's list, and an entry that is further from the ball's centre
than the nearest one by more than the ball's diameter leaves it. A ball with one entry left is owned
whole and gives its sum and count unseen; the points of leaves that are left are compared exactly, in
integers, so results are those of the plain algorithm.

Scale: rounds are maps over the written blocks, whose results are one row per task, part and entry;
codebooks (parts x entries) are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from avisflow.llm.common import table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Points of a leaf, rows of a block at most.
LEAF, BLOCK = 24, 4096
#: Components beyond this (after scaling) could overflow a squared distance.
MOST = 1 << 28


class Tree:
    """A metric tree over integer points: arrays by node, the root last. ``order`` lists the points
    so that each ball holds a run of them, from ``lo`` to ``hi``."""

    def __init__(self, points: np.ndarray):
        self.nodes: list = []  # centre, radius, lo, hi, left, right
        order = self._grow(points.astype(np.float64), np.arange(len(points)), 0)[1]
        self.order = order.astype(np.int32)
        held = points[order]
        self.lo, self.hi, self.left, self.right = (np.array([n[i] for n in self.nodes], np.int32) for i in (2, 3, 4, 5))
        self.centre = np.array([n[0] for n in self.nodes])
        self.radius = np.array([n[1] for n in self.nodes])
        total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(held, axis=0, dtype=np.int64)])
        self.sums = total[self.hi] - total[self.lo]
        del self.nodes

    @classmethod
    def of(cls, arrays: dict) -> Tree:
        out = cls.__new__(cls)
        out.__dict__.update(arrays)
        return out

    def _add(self, centre, radius, lo, hi, left=-1, right=-1) -> int:
        self.nodes.append((centre, radius, lo, hi, left, right))
        return len(self.nodes) - 1

    def _grow(self, points, rows, lo) -> tuple[int, np.ndarray]:
        """The tree of the points ``rows``, which stand from ``lo`` on: its root and their order."""
        own = points[rows]
        n = len(rows)
        centre = own.mean(0) if n else np.zeros(points.shape[1])
        far = np.sqrt(((own - centre) ** 2).sum(1))
        radius = float(far.max(initial=0.0))
        if n <= LEAF or radius == 0:
            return self._add(centre, radius, lo, lo + n), rows
        owner = anchors(own)
        kinds = int(owner.max()) + 1
        if kinds == 1:  # distances too small to tell the points apart
            return self._add(centre, radius, lo, lo + n), rows
        groups = [rows[owner == k] for k in range(kinds)]
        merges = agglomerate(np.array([points[g].mean(0) for g in groups]),
                             np.array([np.sqrt(((points[g] - points[g].mean(0)) ** 2).sum(1)).max() for g in groups]))

        def place(k, at):  # groups below kinds are anchors, the others merged pairs
            if k < kinds:
                return self._grow(points, groups[k], at)
            (left, first), (a, b) = place(merges[k - kinds][0], at), merges[k - kinds]
            right, second = place(b, at + len(first))
            both = np.concatenate([first, second])
            mid = points[both].mean(0)
            return self._add(mid, float(np.sqrt(((points[both] - mid) ** 2).sum(1)).max()), at, at + len(both), left, right), both

        return place(kinds + len(merges) - 1, lo)


def anchors(points: np.ndarray) -> np.ndarray:
    """The anchor that owns each point: about root n anchors. A new one is the point furthest from
    its anchor; points nearer to their anchor than half the way to the new one cannot move."""
    n = len(points)
    owner = np.zeros(n, np.int64)
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    chosen = [0]
    while len(chosen) < int(np.sqrt(n)) + 1:
        new = int(np.argmax(far))
        if far[new] == 0:
            break
        between = np.sqrt(((points[chosen] - points[new]) ** 2).sum(1))
        near = np.flatnonzero(far > between[owner] / 2)
        d = np.sqrt(((points[near] - points[new]) ** 2).sum(1))
        moved = near[d < far[near]]
        owner[moved], far[moved] = len(chosen), d[d < far[near]]
        chosen.append(new)
    return np.unique(owner, return_inverse=True)[1]


def agglomerate(centres: np.ndarray, radii: np.ndarray) -> list[tuple[int, int]]:
    """Pairs to merge, in turn, until one ball is left: always the two whose common ball is smallest."""
    n = len(centres)
    centre = np.concatenate([centres, np.zeros((n - 1, centres.shape[1]))])
    radius = np.concatenate([radii, np.zeros(n - 1)])
    wide = np.full((2 * n - 1, 2 * n - 1), np.inf)
    between = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))
    wide[:n, :n] = np.where(np.eye(n, dtype=bool), np.inf, (between + radii[:, None] + radii[None]) / 2)
    live, out = np.arange(2 * n - 1) < n, []
    for new in range(n, 2 * n - 1):
        a, b = divmod(int(np.argmin(wide[:new, :new])), new)
        out.append((a, b))
        d = float(np.sqrt(((centre[a] - centre[b]) ** 2).sum()))
        radius[new] = max(radius[a], radius[b], (d + radius[a] + radius[b]) / 2)
        centre[new] = centre[a] + (centre[b] - centre[a]) * (np.clip((radius[new] - radius[a]) / d, 0, 1) if d else 0)
        wide[[a, b]], wide[:, [a, b]], live[a], live[b] = np.inf, np.inf, False, False
        live[new] = True
        others = np.flatnonzero(live[:new])
        wide[new, others] = wide[others, new] = (np.sqrt(((centre[others] - centre[new]) ** 2).sum(1)) + radius[others] + radius[new]) / 2
    return out


def owners(tree: Tree, points: np.ndarray, book: np.ndarray):
    """(balls, entries) owned whole, and (points, entries) of the rest; places in the tree's order."""
    entries = book.astype(np.float64)
    node = np.array([len(tree.lo) - 1])
    may = np.ones((1, len(book)), bool)
    balls, ball_of, rest, rest_of = [], [], [], []
    while len(node):
        far = np.sqrt(((tree.centre[node][:, None] - entries[None]) ** 2).sum(2))
        near = np.where(may, far, np.inf).min(1)
        reach = 2 * tree.radius[node]
        # a little slack for rounding: an entry leaves only if it is further away for certain
        may &= far <= (near + reach + 1e-9 * (1 + near + reach))[:, None]
        whole = may.sum(1) == 1
        balls.append(node[whole])
        ball_of.append(may[whole].argmax(1))
        leaf = ~whole & (tree.left[node] < 0)
        for i in np.flatnonzero(leaf):
            at, of = np.arange(tree.lo[node[i]], tree.hi[node[i]]), np.flatnonzero(may[i])
            gap = points[at][:, None] - book[of][None]
            rest.append(at)
            rest_of.append(of[(gap * gap).sum(2).argmin(1)])  # the first of equal ones
        inner = np.flatnonzero(~whole & ~leaf)
        node = np.concatenate([tree.left[node[inner]], tree.right[node[inner]]])
        may = np.concatenate([may[inner], may[inner]])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(balls), np.concatenate(ball_of), np.concatenate(rest + none), np.concatenate(rest_of + none)


def _integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Kept rows: id, label, components as integers."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    ok = F.col(vector_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    most = F.lit(float(MOST))

    def whole(x):
        y = F.floor(x * SCALE)
        return F.when(F.abs(x * SCALE) < most, y).otherwise(F.raise_error(F.lit(f"components must stay below {MOST // SCALE}")).cast("long"))

    return vectors.where(ok).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(v, whole).alias("q"))


def _blocks(rows: DataFrame, width: int) -> DataFrame:
    """Rows in blocks with their trees: ids, labels, and a pickled list of (tree, points) by part."""
    part = width // PARTS

    def run(batches):
        held, size = [], 0

        def block(batch):
            n = batch.num_rows
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(np.asarray(lists.offsets))
            q = np.zeros((n, width), np.int64)  # shorter vectors end with zeros
            q[np.repeat(np.arange(n), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            trees = []
            for p in range(PARTS):
                own = q[:, p * part:(p + 1) * part]
                tree = Tree(own)
                trees.append((vars(tree), own[tree.order].astype(np.int32)))
            cells = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(i)) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([*cells, pa.array([pickle.dumps(trees, 5)], pa.binary())], names=["ids", "labels", "trees"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, BLOCK - size)
                held.append(piece)
                size += piece.num_rows
                at += piece.num_rows
                if size == BLOCK:
                    yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, size = [], 0
        if size:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField("ids", T.ArrayType(kinds["vec_id"])), T.StructField("labels", T.ArrayType(kinds["label"])),
                           T.StructField("trees", T.BinaryType())])
    return table(rows.mapInArrow(run, schema), "vector-trees")


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        parts, entries, part = books.shape
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, part), np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                for p, (tree, points) in enumerate(pickle.loads(blob)):
                    tree, points = Tree.of(tree), points.astype(np.int64)
                    balls, ball_of, rest, rest_of = owners(tree, points, books[p])
                    np.add.at(counts[p], ball_of, (tree.hi - tree.lo)[balls])
                    np.add.at(sums[p], ball_of, tree.sums[balls])
                    np.add.at(counts[p], rest_of, 1)
                    np.add.at(sums[p], rest_of, points[rest])
        at = np.argwhere(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(counts[counts > 0], pa.int64()),
             pa.array(sums[counts > 0].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    width = books.shape[2]
    found = (blocks.select("trees").mapInArrow(run, "part int, entry int, n long, sums array<long>").groupBy("part", "entry")
             .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]).alias("sums")))
    out = books.copy()
    for r in found.collect():  # parts x entries rows at most
        out[r["part"], r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
    return out


def _assigned(blocks: DataFrame, books: np.ndarray, id_type, label_type) -> DataFrame:
    """vec_id, label, code, error of every row."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        for batch in batches:
            for i, blob in enumerate(batch.column(2).to_pylist()):
                ids, labels = (batch.column(c).slice(i, 1).flatten() for c in (0, 1))
                code, error = np.zeros((len(ids), len(books)), np.uint8), np.zeros(len(ids), np.int64)
                for p, (tree, points) in enumerate(pickle.loads(blob)):
                    tree, points = Tree.of(tree), points.astype(np.int64)
                    balls, ball_of, rest, rest_of = owners(tree, points, books[p])
                    of = np.zeros(len(ids), np.int64)
                    sizes = (tree.hi - tree.lo)[balls]
                    of[np.repeat(tree.lo[balls], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.repeat(ball_of, sizes)
                    of[rest] = rest_of
                    code[tree.order, p] = of
                    error[tree.order] += ((points - books[p][of]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("label", label_type), T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    return table(blocks.mapInArrow(run, schema), "vector-codes")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) per kept row, and the final codebooks (part, entry, component).

    Rows whose vector is null or holds null or non-finite components go. Components become
    floor(4096 x) and must stay below 65,536 (an error says so; beyond it squared distances would
    not fit). Vectors shorter than the longest, or than a multiple of the parts, count as ending with
    zeros. First entries are the parts of the ``ENTRIES`` smallest ids (null ids last, equal ids by
    components); fewer rows give fewer entries. Rows that repeat an id are rows of their own; an
    empty table gives no rows and no entries. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = table(_integers(vectors, id_col, vector_col, label_col), "vector-integers")
    longest = rows.agg(F.max(F.size("q"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(ENTRIES).select("q").collect()
    books = np.zeros((PARTS, len(first), width // PARTS), np.int64)
    for k, r in enumerate(first):
        books[:, k] = np.array([*r["q"], *[0] * (width - len(r["q"]))], np.int64).reshape(PARTS, -1)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    if not first:
        return spark.createDataFrame([], T.StructType([T.StructField("vec_id", kinds["vec_id"]), T.StructField("label", kinds["label"]),
                                                       T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])), books
    blocks = _blocks(rows, width)
    for _ in range(rounds):
        books = _round(blocks, books)
    return _assigned(blocks, books, kinds["vec_id"], kinds["label"]), books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, code, error, label_error (errors summed over equal labels, nulls together) and the
    digest of the codebooks."""
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("s_label"), "label_error")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("s_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
