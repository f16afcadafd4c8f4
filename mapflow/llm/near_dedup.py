"""Operator 8: near-duplicates by a MinHash LSH forest, links confirmed on full shingle sets.

- *Sets.* Words are stretches without white space, A-Z lower-cased; a set is the distinct
  shingles of `words` neighbouring words (fewer words: the whole sequence as one shingle).
  Documents with one set are one class and enter the forest once, whatever their number.
- *Signature.* 128 minima, each under a hash function of its own.
- *Forest.* Each of 32 trees is an order of the signatures by its own four minima and the
  four after them. Two sets of similarity s share those four with chance s^4; at 0.8 all
  32 trees miss them with chance 5e-8. Sets with these four in common make a region.
- *Neighbours.* Regions of two sets are compared as they are, in all trees. The others are
  sorted by the whole order, in eight of the trees, and next neighbours are candidates, which
  share the longest prefix that either shares with any set. How long it must be is the
  region's own: at least four, and deeper as long as more than `WIDE` sets share it.
  So each set has at most two candidates in a tree, whatever the size of its region.
- *Completion.* Components of what was confirmed need no more comparison within. Members of
  regions that still span several meet by an exact rule: sets with a link share one of
  their rarest shingles, and at the first they share enough must be left of both (see
  `by_rare_shingles`). This leaves out no pair that a link joins, so what the neighbours
  miss decides about the work and not about the result.
- *Confirmation.* Links are confirmed on the whole sets: a link needs
  ``100 * intersection >= percent * union``.

No group is collected, no candidate dropped. Defined results: null, empty or blank texts
have an empty set, no links and component_id = doc_id. Rows that share a doc_id are taken
for one document. A row without doc_id takes no part: component_id null, kept true. No
documents: no rows. Ties do not occur, as the smallest doc_id stays; other columns are handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import hash_bitmap, may_hold, stored, text_or_empty, unused_name
from mapflow.llm.components import components

MINIMA = 128
TREES = 32
ORDERS = 8  # trees whose sorted orders are read
DEPTH = 4
WIDE = 64
SORTED_ROWS = 1_000_000  # of a sorted partition that are looked at together
BLOCK = 5000
TASK_ROWS = 50_000
TILE = 1000
PARITY_BITS = 1024
TABLE_SIZE = 100_000
SETS = 500  # full sets that are handed on at a time
FILTER_BITS = 24
_RANDOM = np.random.default_rng(20240229)
FACTORS = _RANDOM.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 2**63, MINIMA, dtype=np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hashes of the words a worker has met, emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > TABLE_SIZE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z are lower-cased, only ASCII white space splits
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    many = len(found) - width + 1
    value = np.full(many, width, np.uint64)
    for k in range(width):
        value = _mixed(value * ODD + hashes[k : k + many])
    return np.unique(value)


def parities(values: np.ndarray) -> bytes:
    """For each of `PARITY_BITS` slots whether an odd number of a set's shingles falls there."""
    slots = (values >> np.uint64(20)) % np.uint64(PARITY_BITS)
    return np.packbits(np.bincount(slots.astype(np.int64), minlength=PARITY_BITS) & 1).tobytes()


def signature(values: np.ndarray) -> np.ndarray:
    """The 128 minima of a set (32 bits each)."""
    least = np.full(MINIMA, 2**32 - 1, np.uint64)
    for at in range(0, len(values), 2048):
        block = (values[None, at : at + 2048] * FACTORS[:, None] + OFFSETS[:, None]) >> np.uint64(32)
        np.minimum(least, block.min(1), out=least)
    return least.astype("<u4")


def prefix_keys(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each tree a 64-bit key of its minima, and the four minima after them at 16 bits each."""
    keys = np.arange(TREES, dtype=np.uint64)
    starts = np.arange(TREES) * (MINIMA // TREES)
    for k in range(DEPTH):
        keys = _mixed(keys * ODD + minima[starts + k])
    deeper = np.zeros(TREES, np.uint64)
    for k in range(DEPTH, 2 * DEPTH):
        deeper = (deeper << np.uint64(16)) | (minima[(starts + k) % MINIMA] & np.uint64(0xFFFF))
    return keys.view(np.int64), deeper.view(np.int64)


def marks(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, n_shingles, the set's 128-bit name (`set_a`, `set_b`) and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, minima = [], [], [], []
            with np.errstate(over="ignore"):
                for text in batch.column("text"):
                    values = shingles(text.as_py(), words)
                    sizes.append(len(values))
                    first.append(int(values.sum().astype(np.int64)) if len(values) else 0)
                    second.append(int(_mixed(values ^ ODD).sum().astype(np.int64)) if len(values) else 0)
                    minima.append(signature(values).tobytes() if len(values) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(minima, pa.binary())],
                ["doc_id", "n_shingles", "set_a", "set_b", "minima"],
            )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, minima binary"
    )


def forest(nodes: DataFrame) -> DataFrame:
    """Per set and tree: node, n (set size), key, and the deeper part of the order (in the first `ORDERS` trees)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_trees = np.arange(TREES) < ORDERS
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                with np.errstate(over="ignore"):
                    found = [prefix_keys(np.frombuffer(data.as_py(), "<u4").astype(np.uint64)) for data in part.column("minima")]
                keys, deeper = (np.concatenate(x) for x in zip(*found, strict=True))
                n = part.num_rows
                columns = [pa.array(np.repeat(part.column(c).to_numpy(zero_copy_only=False), TREES), pa.int64()) for c in ("node", "n")]
                deep = pa.array(deeper, pa.int64(), mask=~np.tile(sorted_trees, n))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.int64()), deep], ["node", "n", "key", "deep"])

    return nodes.select("node", "n", "minima").mapInArrow(run, "node long, n long, key long, deep long")


def order_neighbours(key: np.ndarray, deep: np.ndarray, wide: int) -> np.ndarray:
    """Positions whose row is a candidate with the one before, in rows sorted by key and deeper part."""
    apart = (deep[1:] ^ deep[:-1]).view(np.uint64)
    common = DEPTH + sum((apart >> np.uint64(shift) == 0).astype(np.int64) for shift in (48, 32, 16, 0))
    common[key[1:] != key[:-1]] = 0
    chosen = common == 2 * DEPTH
    for depth in range(DEPTH, 2 * DEPTH):
        region = np.concatenate([[0], np.cumsum(common < depth)])
        chosen |= (common == depth) & (np.bincount(region)[region[1:]] <= wide)
    return np.flatnonzero(chosen) + 1


def neighbours(regions: DataFrame) -> DataFrame:
    """Pairs `a, b, n_a, n_b` of sets next to each other in the sorted orders of the forest."""
    wide = WIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "deep", "node", "n")
        held: list[list[np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            key, deep, node, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held[:] = [[x[-1:] for x in (key, deep, node, n)]]  # goes on beside the rows that follow
            at = order_neighbours(key, deep, wide)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (node[at - 1], node[at], n[at - 1], n[at])], ["a", "b", "n_a", "n_b"])

        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in names])
            size += batch.num_rows
            if size > SORTED_ROWS:
                yield out()
                size = 1
        if size > 1:
            yield out()

    rows = regions.where("deep is not null").select("key", "deep", "node", "n")
    # Ranges of the whole order, so a large region may fill any number of tasks.
    return rows.repartitionByRange("key", "deep", "node").sortWithinPartitions("key", "deep", "node").mapInArrow(run, "a long, b long, n_a long, n_b long")


def _slot() -> Column:
    return F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS)


def full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """`node, shingles, parities` for the documents named by `nodes`.

    A bitmap of fixed size (2 MB) says which hash slots are wanted, so other texts are
    passed over while scanning instead of being shuffled for a join; the join with
    `nodes` afterwards is what decides.
    """
    words_of = nodes.select(F.col("node").alias("doc_id")).select(_slot().alias("slot")).groupBy((F.col("slot") / 64).cast("int").alias("at"))
    bits = words_of.agg(F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits")).collect()  # at most 2^18 rows
    bitmap = np.zeros(2**FILTER_BITS // 64, np.int64)
    for row in bits:
        bitmap[row["at"]] = row["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.view(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            rows = np.flatnonzero(wanted[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            for at in range(0, len(rows), SETS):
                part = batch.take(pa.array(rows[at : at + SETS]))
                with np.errstate(over="ignore"):
                    sets = [shingles(t.as_py(), words) for t in part.column("text")]
                odd = pa.array(list(map(parities, sets)), pa.binary())
                sets = [x.view(np.int64) for x in sets]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, odd], ["node", "shingles", "parities"])

    found = (
        docs.where("doc_id is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .withColumn("slot", _slot())
        .mapInArrow(run, "node long, shingles array<long>, parities binary")
    )
    return found.join(nodes.select("node"), "node", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs `a, b` whose full sets are similar enough."""
    nodes = stored(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "compared")
    sets = stored(full_sets(docs, nodes, words).select("node", "shingles"), "full-sets")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return pairs.join(left, "a").join(right, "b").where(100 * shared >= percent * union).select("a", "b").distinct()


def _close_in_size(percent: int) -> Column:
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def links(docs: DataFrame, marked: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links `a, b` between different sets, enough to join all that are linked."""
    filled = marked.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    nodes = (
        filled.join(classes, ["set_a", "set_b"])
        .where("doc_id = node")
        .dropDuplicates(["node", "set_a", "set_b"])
        .select("node", F.col("n_shingles").alias("n"), "minima")
    )
    trees = stored(forest(nodes), "forest")
    one = F.struct("node", "n")
    met = trees.groupBy("key").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.count(F.lit(1)).alias("met")).where("met > 1")
    met = stored(met, "met")
    alone = met.where("met = 2").select(F.col("low.node").alias("a"), F.col("high.node").alias("b"), F.col("low.n").alias("n_a"), F.col("high.n").alias("n_b"))
    regions = stored(trees.join(met.where("met > 2").select("key"), "key", "left_semi"), "regions")
    pairs = alone.unionByName(neighbours(regions)).where(_close_in_size(percent) & (F.col("a") != F.col("b")))
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "neighbours")
    first_links = stored(confirmed(pairs, docs, words, percent), "neighbour-links")

    label = components(first_links)
    labelled = regions.join(label, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    labelled = stored(labelled, "labelled")
    open_nodes = stored(labelled.join(_several(labelled), "key", "left_semi").select("node", "component").distinct(), "open-nodes")
    more = by_rare_shingles(open_nodes, docs, words, percent).join(pairs, ["a", "b"], "left_anti")
    return first_links.unionByName(confirmed(stored(more, "rare-pairs"), docs, words, percent))


def _several(labelled: DataFrame) -> DataFrame:
    """Keys whose rows lie in several components."""
    return labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")


def by_rare_shingles(nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs `a, b` of nodes of different components, among them all that have a link.

    A link needs ``percent`` of the larger set in common. Let shingles be ordered, the rarest
    among these nodes first: of the first ``n - ceil(percent * n / 100) + 1`` shingles of
    each set two linked sets share one, else too few are left. At the first shingle they
    share, all they share is still to come, so the rest of either set must be as large as
    ``percent * (n_a + n_b) / (100 + percent)``: pairs are taken at shingles where it is, and
    where the parities of both sets do not show that too many shingles differ.
    """
    sets = full_sets(docs, nodes, words).select("node", F.xxhash64("shingles").alias("set"), F.size("shingles").alias("n"), "parities", "shingles")
    sets = stored(sets.dropDuplicates(["node", "set"]), "open-sets")
    each = sets.select("node", "set", F.explode("shingles").alias("key"))
    times = each.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    # Shingles of one set alone come first in its order, and are only counted.
    shared = each.join(times, "key").groupBy("node", "set").agg(F.array_sort(F.collect_list(F.struct("times", "key"))).alias("shared"))
    own = F.col("n") - F.size("shared")
    within = F.greatest(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - own, F.lit(0)).cast("int")
    rare = (
        shared.join(sets.drop("shingles"), ["node", "set"])
        .select("node", "n", "parities", own.alias("own"), F.slice("shared", F.lit(1), within).alias("rare"))
        .join(nodes, "node")
        .select("node", "component", "n", "parities", "own", F.posexplode("rare").alias("at", "rare"))
        .select(F.col("rare.key").alias("key"), "node", "component", "n", (F.col("n") - F.col("own") - F.col("at")).alias("left"), "parities")
    )
    rare = stored(rare, "rare-shingles")
    members = rare.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")
    keys = stored(members.where("low <> high").select("key", "members", blocks), "open-keys")
    dealt = rare.join(keys.drop("members"), "key").withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    # A member of a key with more than BLOCK goes to as many pairs of blocks as there are blocks.
    dealt = dealt.select("*", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    dealt = dealt.select("key", "low", "high", "block", "node", "component", "n", "left", "parities")
    n_rows = keys.agg(F.coalesce(F.sum(F.col("members") * F.col("blocks")), F.lit(0))).first()[0]
    tasks = max(1, -(-n_rows // TASK_ROWS))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "low", "high"], kind="stable")
        name = frame[["key", "low", "high"]].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]).any(1)]))
        node, component, n, left, block = (frame[c].to_numpy() for c in ("node", "component", "n", "left", "block"))
        odd = np.frombuffer(b"".join(frame["parities"]), "<u8").reshape(len(frame), -1)
        found = [np.empty((0, 2), np.int64)]
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(frame)], strict=True):
            across = block[start:stop] if name[start, 1] != name[start, 2] else None
            found += possible_links(node[start:stop], component[start:stop], n[start:stop], left[start:stop], odd[start:stop], across, percent)
        pairs = np.unique(np.concatenate(found), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    task = F.pmod(F.xxhash64("key", "low", "high"), F.lit(tasks)).alias("task")
    return dealt.select("*", task).groupBy("task").applyInPandas(run, "a long, b long").distinct()


def possible_links(
    node: np.ndarray, component: np.ndarray, n: np.ndarray, left: np.ndarray, odd: np.ndarray, block: np.ndarray | None, percent: int
) -> list[np.ndarray]:
    """Pairs (smaller node first) of members of a shingle, of different components and of different blocks if those are given.

    Two sets differ in at least as many shingles as their parities do, which bounds what they share.
    """
    fit = np.flatnonzero((100 + percent) * left >= percent * n)  # else too little is left whatever the other
    out = []
    for first in range(0, len(fit), TILE):
        x = fit[first : first + TILE]
        for second in range(first, len(fit), TILE):
            y = fit[second : second + TILE]
            good = (100 + percent) * np.minimum(left[x][:, None], left[y]) >= percent * (n[x][:, None] + n[y])
            good &= component[x][:, None] != component[y]
            if block is not None:
                good &= block[x][:, None] != block[y]
            if first == second:
                good = np.triu(good, 1)
            i, j = np.nonzero(good)
            for at in range(0, len(i), 50_000):
                a, b = x[i[at : at + 50_000]], y[j[at : at + 50_000]]
                both = n[a] + n[b]
                differ = np.bitwise_count(odd[a] ^ odd[b]).sum(1, dtype=np.int64)
                may = (100 + percent) * (both - differ) >= 2 * percent * both
                out.append(np.sort(np.column_stack([node[a[may]], node[b[may]]]), axis=1))
    return out


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    marked = stored(marks(docs, words), "marks")
    filled = marked.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("class_id"))
    # Copies hang on their class; a doc_id with several texts hangs on several and so joins them.
    ties = filled.join(classes, ["set_a", "set_b"]).select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    label = components(links(docs, marked, words, percent).unionByName(ties))
    whole = label.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    out = marked.select("doc_id", "n_shingles").join(whole, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, all its columns. Rows that repeat a kept doc_id stay."""
    gone = unused_name(docs, "gone")
    dropped = stored(near_groups(docs, words, percent).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct(), "near-dropped")
    number = F.col("doc_id").cast("long")
    # Most kept documents pass by a bitmap instead of a join, without a shuffle of their texts.
    possible = F.coalesce(may_hold(hash_bitmap(dropped.select(F.xxhash64(gone).alias("hash"))), F.xxhash64(number)), F.lit(False))
    return docs.where(~possible).unionByName(docs.where(possible).join(dropped, number == F.col(gone), "left_anti"))
