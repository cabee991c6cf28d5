"""Groups of members that share a key, walked in blocks of bounded size, and exact links inside a block.

``members`` has a row per (key, node) with n (set size) and comp (the component known so far).
A block is what one call of a walk sees; a walk returns rows in proportion to the rows of its
block, never one per pair.

- ``gathered`` puts small clusters of groups that share nodes under one key.
- ``own`` deals each group to as many blocks as its rows and items ask for, by a hash of the node.
- ``crossed`` is for groups of several blocks only: the nodes outside the largest component of the
  group, the minor ones, meet every block.  Nodes of one component need not meet, so a group costs
  its rows and, per minor node, one row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.store import dropped, written
from loanlens.llm.text import offsets_of, rest, tidied

ROWS = 2048  # rows of a block; what a walk holds grows with their square
ITEMS = 1 << 20  # set items of a block
PLACE = ["key", "x", "y"]
_TILE = 4096  # columns of the incidence matrix at once


def _sizes(members: DataFrame) -> DataFrame:
    """Per mixed group (one of several components): blocks, minor_blocks and its largest component."""
    per = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    size = per.groupBy("key").agg(F.sum("c").alias("rows"), F.sum("s").alias("items"), F.count(F.lit(1)).alias("comps"),
                                  F.max("c").alias("top"), F.max_by("comp", F.struct("c", "comp")).alias("major"))
    blocks = F.greatest(F.ceil(F.col("rows") / ROWS), F.ceil(F.col("items") / ITEMS)).cast("int")
    minor = F.greatest(F.ceil((F.col("rows") - F.col("top")) / ROWS), F.lit(1)).cast("int")
    return size.where("comps > 1").select("key", blocks.alias("blocks"), minor.alias("minor_blocks"), "major")


def _slot(of: str, seed: int = 0):
    return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(of)).cast("int")


def own(members: DataFrame) -> DataFrame:
    """``members`` of mixed groups with their place: x the block, y and side 0."""
    sizes = _sizes(members).drop("minor_blocks", "major")
    return members.join(sizes, "key").withColumn("x", _slot("blocks")).drop("blocks") \
        .withColumn("y", F.lit(0)).withColumn("side", F.lit(0))


def crossed(members: DataFrame) -> DataFrame:
    """Places (x, y) of mixed groups of several blocks: side 0 is block x, side 1 the minor nodes of minor block y."""
    m = members.join(_sizes(members).where("blocks > 1"), "key")
    here = F.transform(F.sequence(F.lit(0), F.col("minor_blocks") - 1),
                       lambda y: F.struct(_slot("blocks").alias("x"), y.alias("y"), F.lit(0).alias("side")))
    there = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda x: F.struct(x.alias("x"), _slot("minor_blocks", 1).alias("y"), F.lit(1).alias("side")))
    places = F.when(F.col("comp") == F.col("major"), here).otherwise(F.concat(here, there))
    return m.select(*members.columns, F.explode(places).alias("p")).select(*members.columns, "p.x", "p.y", "p.side")


def regrouped(place: Callable[[DataFrame], DataFrame], left: DataFrame) -> DataFrame:
    """Places of gathered members: groups of several blocks by ``place``, those that fit a block by now as they are."""
    if place is own:
        return own(left)
    single = _sizes(left).where("blocks = 1").select("key")
    return crossed(left).unionByName(own(left.join(single, "key", "left_semi")))


def gathered(alive: DataFrame, of: DataFrame, components: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The members (key, node) that are left of groups, with those of one cluster gathered under one key.

    Near copies share many keys, and their sets would be sent to each of them.  Nodes that hang
    together by shared keys are a cluster; one that fits a block is a group of its own, in which every node
    lies once.  Nodes of larger clusters stay in their groups.
    """
    at = alive.join(of.select("node", "id", "n"), "node")
    head = at.groupBy("key").agg(F.min("id").alias("v"))
    cluster = components(at.join(head, "key").where("id <> v").select(F.col("id").alias("u"), "v")).withColumnRenamed("node", "id")
    nodes = at.select("id", "node", "n").distinct().join(cluster, "id")
    small = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).where((F.col("c") <= ROWS) & (F.col("s") <= ITEMS))
    nodes = nodes.join(small.select("component", F.lit(True).alias("fits")), "component", "left")
    one = nodes.where("fits").select(F.xxhash64("component", F.lit(17)).alias("key"), "node")
    rest_ = alive.join(nodes.where("fits is null").select("node"), "node", "left_semi").select("key", "node")
    return one.unionByName(rest_).distinct()


def completed(members: DataFrame, sets: DataFrame, comp: DataFrame, components: Callable[[DataFrame], DataFrame],
              alive: Callable[[DataFrame], DataFrame], block_links: Callable[[DataFrame], DataFrame], light: list[str], full: list[str]) -> DataFrame:
    """(node, component) after all links between components: ``comp`` holds those of the links known so far.

    ``alive`` leaves the members of placed groups (with the columns ``light`` of ``sets``) that can have a partner in another
    component, ``block_links`` (with ``full``) finds the links of those.  Groups of one block are done then; the others are crossed.
    """
    for place in (own, crossed):
        of = sets.select("id", "node", "n").join(comp.withColumnRenamed("node", "id"), "id", "left") \
            .select("id", "node", "n", F.coalesce("component", "id").alias("comp"))
        at = members.join(of, "node")
        if place is crossed and at.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")) \
                .where((F.col("c") > ROWS) | (F.col("s") > ITEMS)).isEmpty():
            break
        some = written(alive(place(at).join(sets.select("id", *light), "id")).distinct(), "alive")
        if not some.isEmpty():
            left = written(gathered(some, of, components), "gathered")
            new = written(block_links(regrouped(place, left.join(of, "node")).join(sets.select("id", *full), "id")), "links")
            if not new.isEmpty():
                comp = components(comp.select(F.col("component").alias("u"), F.col("node").alias("v")).unionByName(new))
        dropped(some)
    return comp


def walk(placed: DataFrame, each: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str, owner: str) -> DataFrame:
    """Apply ``each`` to runs of whole blocks (a table and the row where each block begins)."""

    @tidied(owner)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last block of a batch waits for its rest
        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in PLACE]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            same = bool(held) and all(held[-1].column(c)[-1].as_py() == batch.column(c)[0].as_py() for c in PLACE)
            if (not held or same) and not len(changes):
                held.append(batch)
                waiting += batch.num_rows
                continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            begin = np.concatenate(([0], [waiting] if held and not same else [], changes + waiting)).astype(np.int64)
            yield from each(table.slice(0, begin[-1]), begin[:-1])
            held = table.slice(begin[-1]).to_batches()
            waiting = table.num_rows - int(begin[-1])
            rest()
        if held:
            yield from each(pa.Table.from_batches(held).combine_chunks(), np.zeros(1, np.int64))

    return placed.repartition(*[F.col(c) for c in PLACE]).sortWithinPartitions(*PLACE).mapInArrow(run, schema)


def lists_of(table: pa.Table, column: str) -> list[np.ndarray]:
    """The rows of an array<long> column as unsigned numpy views."""
    arr = table.column(column).combine_chunks()
    arr = arr.chunk(0) if isinstance(arr, pa.ChunkedArray) else arr
    off = np.frombuffer(arr.buffers()[1], np.int32, len(arr) + 1, arr.offset * 4)
    values = arr.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return [values[a:b] for a, b in zip(off[:-1], off[1:])]


def overlaps(items: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs (i, j) of sorted sets.

    Few pairs are merged one by one; many come from the product of the incidence matrix of the
    items that occur more than once with itself, in tiles of columns.
    """
    rows, at = np.unique(np.concatenate((i, j)), return_inverse=True)
    a, b = at[:len(i)], at[len(i):]
    size = np.array([len(items[r]) for r in rows])
    flat = np.concatenate([items[r] for r in rows]) if len(rows) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(rows)), size)
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[inverse][shared[inverse]]
    owner = owner[shared[inverse]]
    width = int(shared.sum())
    if len(i) * (2e-5 + 4e-8 * (size.mean() if len(size) else 0)) < len(rows) ** 2 * width * 1e-10:
        return np.array([np.intersect1d(items[p], items[q], assume_unique=True).size for p, q in zip(i, j)], np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(rows), len(rows)), np.float32)
    for s in range(0, width, _TILE):
        lo, hi = np.searchsorted(column, [s, s + _TILE])
        tile = np.zeros((len(rows), min(_TILE, width - s)), np.float32)
        tile[owner[lo:hi], column[lo:hi] - s] = 1
        both += tile @ tile.T
    return both[a, b].astype(np.int64)


def forest(i: np.ndarray, j: np.ndarray, comp: np.ndarray) -> list[tuple[int, int]]:
    """Links out of (i, j) that join the components as all of them do: at most one per component.

    A search over rows; rows of a component are reached together.
    """
    linked = np.zeros((len(comp), len(comp)), bool)
    linked[i, j] = linked[j, i] = True
    order = np.argsort(comp, kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], comp[order][1:] != comp[order][:-1])))
    of = np.empty(len(comp), np.int64)
    of[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(comp))))
    mates = np.split(order, begin[1:])
    open_, out = np.ones(len(comp), bool), []
    for first in np.unique(np.concatenate((i, j))):
        if not open_[first]:
            continue
        queue = list(mates[of[first]])
        open_[queue] = False
        while queue:
            p = queue.pop()
            for q in np.flatnonzero(linked[p] & open_):
                if open_[q]:
                    out.append((int(p), int(q)))
                    open_[mates[of[q]]] = False
                    queue.extend(mates[of[q]])
    return out


def links(table: pa.Table, i: np.ndarray, j: np.ndarray, percent: int) -> pa.RecordBatch:
    """Verified links (u, v by ``id``) of candidate pairs (i, j) of a block: a forest over its components."""
    comp, n, ids = (table.column(c).to_numpy() for c in ("comp", "n", "id"))
    both = overlaps(lists_of(table, "items"), i, j) if len(i) else np.zeros(0, np.int64)
    ok = 100 * both >= percent * (n[i] + n[j] - both)
    found = np.array(forest(i[ok], j[ok], comp), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ids[found[:, 0]], pa.int64()), pa.array(ids[found[:, 1]], pa.int64())], ["u", "v"])


def spans(begin: np.ndarray, rows: int) -> list[tuple[int, int]]:
    return list(zip(begin.tolist(), [*begin[1:].tolist(), rows]))


def binary_sizes(table: pa.Table, column: str) -> np.ndarray:
    arr = table.column(column).combine_chunks()
    arr = arr.chunk(0) if isinstance(arr, pa.ChunkedArray) else arr
    return np.diff(offsets_of(arr))
