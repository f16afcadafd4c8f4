"""Operator 5: approximate nearest neighbours by a forest of random-projection trees.

- *Trees.* A node splits its points by their projection on the line between two of them,
  at the median. The forest is grown on a sample of at most `most_sampled` vectors
  (smallest hash of vec_id first) and sent to all tasks; its size is bounded by the sample.
- *Index.* Every row goes down every tree to its leaf, and keeps the numbers of its leaves.
- *Search.* A query goes down all trees in the order of one shared priority queue: the branch
  not taken whose border is nearest comes next, whichever tree it is in, until a share `visit`
  of all leaves has been reached. It keeps a bit for each leaf.
- *Reranking.* A block of queries meets a block of rows, both of bounded size, in one task. A
  row counts for a query that visits one of its leaves; each task keeps a query's best rows
  by the exact measure, and those are ranked. The visited leaves of all trees hold more rows
  than the table at the default `visit`, so a task first multiplies all its pairs in single
  precision: only pairs that may be among the best are looked up and multiplied exactly. Rows
  and queries are never copied by tree or by leaf. Work grows as queries times rows.

The measure is the largest inner product of the original vectors, in double precision,
ties to the smaller vec_id. For the trees, vectors get one more coordinate that brings
all to the length of the longest, so that a small angle means a large product.

Of equal vectors only the k + 1 with the smallest vec_ids are searched: no others can be
among a query's k nearest. Equal queries are searched once. Defined results: vectors that
are null, empty, zero, of another length than most, or hold a null or non-finite
component take no part, nor do rows without vec_id; rows repeated in full count once;
rows that share the query's vec_id are the query's own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapflow.llm.common import stored

TREES = 10
VISIT = 0.14
LEAF_ROWS = 1000
MOST_SAMPLED = 20_000
LEAST_IN_LEAF = 16
#: Numbers in the vectors of a block of rows; a block of queries, which have a bit for each leaf too, holds half as many.
BLOCK_NUMBERS = 2**22
#: Numbers in vectors that are worked on at once.
SLICE = 2**20
#: Queries and rows multiplied at once; the best are ranked after the first rows, and whenever as many more have been seen.
QUERY_ROWS = 512
MOST_ROWS = 4096
FIRST_ROWS = 256
MOST_TASKS = 4000
#: Queries that go down the forest together.
SEARCHED = 64


@dataclass
class Tree:
    """Nodes in one array each; a child below zero is leaf -child - 1."""

    lines: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64) if len(self.cuts) else np.full(len(points), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            nodes = at[inner]
            right = np.einsum("ij,ij->i", points[inner], self.lines[nodes]) > self.cuts[nodes]
            at[inner] = self.children[nodes, right.astype(int)]
        return -at - 1


def grow(points: np.ndarray, leaves: int, rng: np.random.Generator) -> Tree:
    """One tree with at most that many leaves."""
    lines, cuts, children = [], [], []
    count = 0

    def node(index: np.ndarray, share: int) -> int:
        nonlocal count
        line = None
        if share > 1 and len(index) > 1:
            for _ in range(5):
                a, b = points[rng.choice(index, 2, replace=False)]
                if np.linalg.norm(a - b) > 1e-12:
                    line = (a - b) / np.linalg.norm(a - b)
                    break
        if line is None:
            count += 1
            return -count
        projected = points[index] @ line
        cut = np.median(projected)
        right = projected > cut
        if right.all() or not right.any():
            count += 1
            return -count
        me = len(cuts)
        lines.append(line)
        cuts.append(cut)
        children.append((0, 0))
        children[me] = (node(index[~right], share // 2), node(index[right], share - share // 2))
        return me

    node(np.arange(len(points)), leaves)
    width = points.shape[1]
    return Tree(np.array(lines).reshape(-1, width), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), count)


@dataclass
class Forest:
    trees: list[Tree]
    longest: float

    @property
    def width(self) -> int:
        """Components of a vector."""
        return self.trees[0].lines.shape[1] - 1

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """With the coordinate that makes all lengths equal."""
        rest = np.maximum(self.longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0.0)
        return np.column_stack([vectors, np.sqrt(rest)])

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf numbers (over the whole forest) by row and tree."""
        points = self.lifted(vectors)
        first = np.cumsum([0, *(t.leaves for t in self.trees)])
        return np.column_stack([t.leaf_of(points) + f for t, f in zip(self.trees, first, strict=False)])

    @cached_property
    def levels(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By depth, inner nodes and their two children, numbered over the forest; leaves come after all inner nodes."""
        inner = np.cumsum([0, *(len(t.cuts) for t in self.trees)])
        first = np.cumsum([0, *(t.leaves for t in self.trees)]) + inner[-1]
        children = [np.where(t.children < 0, f - t.children - 1, t.children + i) for t, i, f in zip(self.trees, inner, first, strict=False)]
        every, nodes, out = np.concatenate(children), inner[:-1][np.diff(inner) > 0], []
        while nodes.size:
            out.append((nodes, every[nodes]))
            nodes = every[nodes][every[nodes] < inner[-1]]
        return out

    def search(self, vectors: np.ndarray, visit: float) -> np.ndarray:
        """Whether each query visits each leaf: those behind the nearest borders.

        The farthest border on the way to a leaf is its distance, the one by which a shared priority queue would come
        upon it. Of leaves as far as the last one visited, those are taken that the queue would give first.
        """
        counts = np.cumsum([0, *(len(t.cuts) for t in self.trees)])
        n_leaves = sum(t.leaves for t in self.trees)
        wanted = min(max(len(self.trees), int(np.ceil(visit * n_leaves))), n_leaves)
        sides = np.empty((counts[-1], len(vectors)))
        for at, vector in enumerate(vectors):
            point = np.append(vector, 0.0) / np.linalg.norm(vector) * self.longest
            for tree, start in zip(self.trees, counts, strict=False):
                if len(tree.cuts):
                    sides[start : start + len(tree.cuts), at] = tree.lines @ point - tree.cuts
        far = np.full((counts[-1] + n_leaves, len(vectors)), -1.0)
        for nodes, children in self.levels:
            border = np.fmax(far[nodes], np.abs(sides[nodes]))
            right = sides[nodes] > 0
            far[children[:, 0]] = np.where(right, border, far[nodes])
            far[children[:, 1]] = np.where(right, far[nodes], border)
        out = np.empty((len(vectors), n_leaves), bool)
        far, sides = np.ascontiguousarray(far.T), np.ascontiguousarray(sides.T)
        for at in range(len(vectors)):
            leaf = far[at, counts[-1] :]
            last = np.partition(leaf, wanted - 1)[wanted - 1]
            out[at] = leaf <= last
            if np.count_nonzero(out[at]) > wanted:
                out[at] = leaf < last
                out[at, self._first_at(last, sides[at], far[at], wanted - np.count_nonzero(out[at]))] = True
        return out

    def _first_at(self, border: float, sides: np.ndarray, far: np.ndarray, wanted: int) -> list[int]:
        """The first leaves at that distance in the order of a priority queue of (border, tree, node)."""
        inner = np.cumsum([0, *(len(t.cuts) for t in self.trees)])
        first = np.cumsum([0, *(t.leaves for t in self.trees)])
        entries = [x[(far[x] == border) & (far[nodes] < border)[:, None]] for nodes, x in self.levels]
        queue = []
        for node in np.concatenate(entries).tolist():
            if node < inner[-1]:
                tree = int(np.searchsorted(inner, node, "right")) - 1
                queue.append((tree, node - int(inner[tree])))
            else:
                tree = int(np.searchsorted(first, node - inner[-1], "right")) - 1
                queue.append((tree, int(first[tree]) - (node - int(inner[-1])) - 1))
        heapq.heapify(queue)
        found: list[int] = []
        while len(found) < wanted:
            tree, node = heapq.heappop(queue)
            while node >= 0:
                side = sides[inner[tree] + node]
                left, right = self.trees[tree].children[node].tolist()
                near, other = (right, left) if side > 0 else (left, right)
                if not abs(side) > border:
                    heapq.heappush(queue, (tree, other))
                node = near
            found.append(int(first[tree]) - node - 1)
        return found


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id, vector` of the rows that take part; floats stay floats, all else becomes doubles."""
    element = getattr(vectors.schema["embedding"].dataType, "elementType", None)
    vector = F.col("embedding").cast("array<float>" if isinstance(element, T.FloatType) else "array<double>")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & sound
    )
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    return rows.where(F.size("vector") == (widths["width"] if widths else 0)).distinct()


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(whole), -1) if len(whole) else flat.reshape(0, 0)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most `SLICE` numbers, and their vectors as doubles."""
    for batch in batches:
        if batch.num_rows:
            width = len(batch.column("vector")[0])
            for at in range(0, batch.num_rows, step := max(1, SLICE // width)):
                part = batch.slice(at, step)
                yield part, _matrix(part.column("vector")).astype(float)


def first_by_hash(rows: DataFrame, n: int, most: int) -> np.ndarray:
    """Vectors of the `most` rows with the smallest hash of vec_id; only hashes below a border that lets a few more pass are sorted."""
    wanted, share = min(most, n), 1.2 * most / n + 0.001
    while True:
        some = rows if share >= 1 else rows.where(F.xxhash64("vec_id") < int(2**64 * share) - 2**63)
        sample = some.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("vector").toArrow()  # bounded
        if sample.num_rows >= wanted or share >= 1:
            return _matrix(sample.column("vector")).astype(float)
        share *= 4


def fit(rows: DataFrame, n: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, most_sampled: int = MOST_SAMPLED) -> Forest:
    square = lambda a, x: a + x.cast("double") * x.cast("double")
    longest = rows.agg(F.max(F.aggregate("vector", F.lit(0.0), square))).first()[0]
    forest = Forest([], float(np.sqrt(longest)) if longest else 0.0)
    points = forest.lifted(first_by_hash(rows, n, most_sampled))
    leaves = max(1, min(-(-n // leaf_rows), len(points) // LEAST_IN_LEAF))
    leaves = max(leaves, min(32, len(points) // LEAST_IN_LEAF))
    forest.trees = [grow(points, leaves, np.random.default_rng(100 + t)) for t in range(trees)]
    return forest


def met(visits: np.ndarray, leaves: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Whether a query visits a leaf of a row, for pairs of them; visits are bits by leaf."""
    found = np.zeros(len(q), np.uint8)
    for tree in range(leaves.shape[1]):
        leaf = leaves[r, tree]
        found |= visits[q, leaf >> 3] >> (leaf & 7).astype(np.uint8)
    return (found & 1).astype(bool)


def best_rows(
    queries: np.ndarray, visits: np.ndarray, ids: np.ndarray, vectors: np.ndarray, leaves: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the best rows it meets: query positions, ids, exact products; ties to smaller ids, of an id its best row.

    Single-precision products of unit vectors tell which pairs may still be among the best; only those are looked up
    and multiplied exactly. The border lies lower by more than single precision can err.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    width = vectors.shape[1]
    step = max(1, SLICE // width)
    margin = (width + 16) * 2.0**-22
    repeated = len(np.unique(ids)) < len(ids)
    with np.errstate(all="ignore"):  # lengths beyond doubles make NaN: such pairs are all looked at
        lengths = np.concatenate([np.linalg.norm(vectors[at : at + step].astype(float), axis=1) for at in range(0, len(ids), step)])
        longest = lengths.max()
        scaled = np.concatenate([(vectors[at : at + step].astype(float) / longest).astype(np.float32) for at in range(0, len(ids), step)])
        for at in range(0, len(queries), QUERY_ROWS):
            block, seen = queries[at : at + QUERY_ROWS].astype(float), visits[at : at + QUERY_ROWS]
            length = np.linalg.norm(block, axis=1)
            unit = (block / length[:, None]).astype(np.float32)
            scale = np.where(length * longest > 1e-280, length * longest, np.nan)  # products too small to be exact set no border
            low = np.full((len(block), 1), -np.inf, np.float32)
            best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            pending, start, ranked = [best], 0, FIRST_ROWS
            while start < len(ids):
                end = min(start + MOST_ROWS, ranked, len(ids))
                q, r = np.divmod(np.flatnonzero(~(unit @ scaled[start:end].T < low)), end - start)
                r += start
                meeting = met(seen, leaves, q, r)
                q, r = q[meeting], r[meeting]
                for i in range(0, len(q), step):
                    left, right = block[q[i : i + step]], vectors[r[i : i + step]].astype(float)
                    pending.append((q[i : i + step], ids[r[i : i + step]], np.einsum("ij,ij->i", left, right)))
                start = end
                if start == len(ids) or start == ranked:
                    q, i, score = (np.concatenate(x) for x in zip(*pending, strict=True))
                    if repeated:
                        order = np.lexsort((-score, i, q))
                        q, i, score = q[order], i[order], score[order]
                        new = np.append(True, (q[1:] != q[:-1]) | (i[1:] != i[:-1]))[: len(q)]
                        q, i, score = q[new], i[new], score[new]
                    order = np.lexsort((i, -score, q))
                    q, i, score = q[order], i[order], score[order]
                    firsts = np.searchsorted(q, np.arange(len(block) + 1))
                    full = np.flatnonzero(np.diff(firsts) >= most)
                    low[full, 0] = score[firsts[full] + most - 1] / scale[full] - margin
                    keep = np.arange(len(q)) - firsts[q] < most
                    best = (q[keep], i[keep], score[keep])
                    pending, ranked = [best], 2 * ranked
            out.append((best[0] + at, *best[1:]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    trees: int = TREES,
    visit: float = VISIT,
    leaf_rows: int = LEAF_ROWS,
    most_sampled: int = MOST_SAMPLED,
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest found. `is_query` tells queries by vec_id."""
    copies = Window.partitionBy(F.xxhash64("vector"), "vector").orderBy("vec_id")
    rows = usable(vectors)
    index = stored(rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "index-rows")
    asked = stored(rows.where(is_query), "queries")
    firsts = asked.groupBy("vector").agg(F.min("vec_id").alias("first"))
    firsts = stored(firsts, "first-queries")
    n, n_queries = index.count(), firsts.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or not n_queries:
        return vectors.sparkSession.createDataFrame([], schema)
    forest = fit(index, n, trees, leaf_rows, most_sampled)
    shared = vectors.sparkSession.sparkContext.broadcast(forest)
    kind, width = rows.schema["vector"].dataType.simpleString(), forest.width
    row_blocks = max(-(-n // max(1, BLOCK_NUMBERS // width)), min(8, -(-n // 2048)))
    query_blocks = -(-n_queries // max(1, BLOCK_NUMBERS // 2 // width))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, points in _slices(batches):
            leaf = shared.value.leaves_of(points).astype(np.int32)
            offsets = np.arange(0, leaf.size + 1, leaf.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, leaf.ravel()), *batch.columns], ["leaves", *batch.schema.names])

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, points in _slices(batches):
            parts = (points[at : at + SEARCHED] for at in range(0, len(points), SEARCHED))
            bits = [x.tobytes() for part in parts for x in np.packbits(shared.value.search(part, visit), axis=1, bitorder="little")]
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary()), *batch.columns], ["visits", *batch.schema.names])

    def ranked(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["first", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        visits = np.frombuffer(b"".join(left["visits"].to_pylist()), np.uint8).reshape(left.num_rows, -1)
        q, ids, score = best_rows(
            _matrix(left["vector"]), visits, right["vec_id"].to_numpy(), _matrix(right["vector"]), _matrix(right["leaves"]), k + 1
        )
        return pa.table([left["first"].to_numpy()[q], ids, score], names)

    # A cell is a block of queries and one of rows, each of bounded size; every row is in one block, whatever the number of trees.
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    inside = index.mapInArrow(placed, f"leaves array<int>, vec_id long, vector {kind}")
    inside = inside.withColumn("row_block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(row_blocks))).withColumn("query_block", every(query_blocks))
    visits = firsts.mapInArrow(sought, f"visits binary, vector {kind}, first long")
    visits = visits.withColumn("query_block", F.pmod(F.xxhash64("first", "vector"), F.lit(query_blocks))).withColumn("row_block", every(row_blocks))
    tasks = min(4 * row_blocks * query_blocks, MOST_TASKS)  # more than cells, so that few share a task
    cell = F.col("row_block") * query_blocks + F.col("query_block")
    by_cell = lambda x: x.withColumn("cell", cell).repartition(tasks, "cell").groupBy("cell")
    met_rows = by_cell(visits).cogroup(by_cell(inside)).applyInArrow(ranked, "first long, vec_id long, score double").repartition("first")
    order = lambda key: Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    best = met_rows.groupBy("first", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("place", F.row_number().over(order("first"))).where(F.col("place") <= k + 1).drop("place")
    each = asked.join(firsts, "vector").select(F.col("vec_id").alias("query_id"), "first")
    return (
        each.join(best, "first")
        .where("query_id <> vec_id")
        .select("query_id", F.row_number().over(order("query_id")).alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )
