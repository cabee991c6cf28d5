"""Similarity join of documents on word shingles, by signature trees.

A document is the set of its distinct ``k``-word shingles (64-bit hashes).  Two documents
link when 100 * intersection >= percent * union; the result is the components of the links.

1. Equal sets are one node, whoever many copies there are.
2. Leaves of the forest: sets of a size class that differ little agree wholly on some part
   of a fixed partition of the shingle space.  Of m parts, sets that differ in d shingles
   agree on m - d at least, so a node that keeps only its d + 1 heaviest parts, d being the
   most that it can differ from a partner, still shares one with each.  Nodes under the same part content are a group; a group is cut into
   blocks, so that no key gathers more in one task.
3. Each block is a signature tree: nodes hold the OR of the token bitmaps below them and the
   range of sizes.  Two trees (or one with itself) are walked level by level in pairs, and a
   pair of nodes goes on only if the overlap that its bitmaps and sizes allow can reach the
   threshold.  Pairs of documents already in one component are passed by.
4. Pairs that are left are verified on the whole sets.  First each node tries its most
   promising smaller partner.  Then the walk marks the members of a group that keep a possible
   partner in another component; their sets are verified block by block, every pair that the
   trees leave, and a block sends only links that join two components: no link between
   components is lost, and no group has its pairs emitted.  Groups of several blocks are
   crossed by the nodes outside their largest component.

Defined results: a null text or one without words has an empty set and is alone; equal
documents are in one component; rows that share a doc_id but not the text are documents of
their own; a null doc_id links as any other; the component is its smallest doc_id (an integer;
null only if all of its doc_ids are).  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.blocks import binary_sizes, completed, links, spans, walk
from loanlens.llm.components import components
from loanlens.llm.store import dropped, written
from loanlens.llm.text import bytes_of, filled, lower_ascii, mix, shingles, slices, tidied, word_hashes, word_spans

CLASS_RATIO = 2  # sizes of a class lie within this ratio
SPARE_PARTS = 6  # one part more for so many; the more parts, the lighter those that a node can leave out
BLOCK_ROWS = 768  # documents of a tree; what a walk holds grows with their square
FANOUT = 16
BRIEF_BYTES = 64  # of the folded bitmap used in the first round
_SALT = 0x5851F42D4C957F2D


def _class_bounds(limit: int) -> np.ndarray:
    """Smallest size of each class, up to the second class beyond ``limit``."""
    out = [1]
    while len(out) < 3 or out[-3] <= limit:
        out.append(max(out[-1] + 1, int(out[-1] * CLASS_RATIO)))
    return np.array(out, np.int64)


def _parts(top: int, percent: int) -> int:
    """Parts for sets of at most ``top`` shingles: more than two of them can differ in."""
    d = 2 * top * (100 - percent) // (100 + percent)
    return d + 1 + d // SPARE_PARTS


def part_keys(own: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Group keys of each set (sorted shingles ``own``, offsets ``first``) and the set that each belongs to."""
    n = np.diff(first)
    if not len(own):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _class_bounds(int(n.max()) * 100 // percent + 1)
    cls = np.searchsorted(low, n, side="right") - 1
    keys, sets = [], []
    for c in np.unique(cls[n > 0]):
        at = np.flatnonzero((cls == c) & (n > 0))
        k = c - 1
        while True:  # its own class, and the next ones as far as it may link with their sets
            k += 1
            members = at if k == c else at[100 * n[at] >= percent * low[k]]
            if not len(members):
                break
            m = _parts(int(low[k + 1]) - 1, percent)
            row = np.repeat(np.arange(len(members)), n[members])
            item = own[np.repeat(first[members] - np.cumsum(n[members]) + n[members], n[members]) + np.arange(n[members].sum())]
            cell = row * m + (mix(item ^ np.uint64(_SALT)) % np.uint64(m)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            cell, item = cell[order], item[order]
            begin = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            count = np.zeros(len(members) * m, np.int64)
            content = np.zeros(len(members) * m, np.uint64)
            count[cell[begin]] = np.diff(np.append(begin, len(cell)))
            content[cell[begin]] = np.add.reduceat(mix(item), begin)
            part = np.tile(np.arange(m, dtype=np.uint64), len(members))
            key = mix(content + mix(part * np.uint64(0x9E3779B97F4A7C15) + np.uint64(int(k) + 1)))
            # heaviest first, by what the part holds only, so both sides of a pair choose alike
            rank = np.lexsort((key.reshape(-1, m), -count.reshape(-1, m)), axis=1)
            size = n[members]
            differ = (100 - percent) * (size + np.minimum(int(low[k + 1]) - 1, 100 * size // percent)) // (100 + percent)
            kept = np.arange(m) <= differ[:, None]
            keys.append(np.take_along_axis(key.reshape(-1, m), rank, 1)[kept])
            sets.append(np.repeat(members, differ + 1))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(sets)


def bitmap(own: np.ndarray, bits: int) -> np.ndarray:
    """Token bitmap of one set, ``bits`` (a power of two, 64 at least) wide, as 64-bit words; wider ones fold onto narrower ones."""
    out = np.zeros(bits, bool)
    out[(mix(own) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64)


def _width(n: int) -> int:
    return max(8 * BRIEF_BYTES, 1 << max(0, int(2 * n - 1).bit_length()))


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """The bitmap of ``width`` 64-bit words that the same tokens give."""
    return np.bitwise_or.reduce(words.reshape(-1, width), axis=0)


def _text_sets(part: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    raw, off = bytes_of(part.column("text"))
    raw = lower_ascii(raw)
    starts, ends, first = word_spans(raw, off)
    return shingles(word_hashes(raw, starts, ends), first, k)


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        yield from slices(batch.set_column(names.index("text"), "text", filled(batch.column("text"))), "text")


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n (set size), node and check (128 bits of the set), brief (folded bitmap), keys of each document."""

    @tidied("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches):
            own, first = _text_sets(part, k)
            n = np.diff(first)
            node, check = _identity(own, first)
            brief = [bitmap(own[a:b], 8 * BRIEF_BYTES).tobytes() if b > a else bytes(BRIEF_BYTES) for a, b in zip(first[:-1], first[1:])]
            key, of = part_keys(own, first, percent)
            order = np.argsort(of, kind="stable")
            at = np.searchsorted(of[order], np.arange(len(n) + 1))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(key[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(n, pa.int64()), pa.array(node), pa.array(check),
                 pa.array(brief, pa.binary()), lists], ["doc_id", "text_hash", "n", "node", "check", "brief", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "text_hash").mapInArrow(
        run, f"doc_id {kind}, text_hash long, n long, node long, check long, brief binary, keys array<long>")


def _identity(own: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """128 bits of each set, whatever the order of its shingles."""
    out = []
    for salt in (0x1234567, 0xABCDEF01):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(own + np.uint64(salt)))))
        out.append(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64))
    return out


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """n, node, check, items (sorted shingles) and bits (bitmap as wide as the set asks for) of each text."""

    @tidied("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches):
            own, first = _text_sets(part, k)
            node, check = _identity(own, first)
            items = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(own.view(np.int64)))
            bits = [bitmap(own[a:b], _width(b - a)).tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(first), pa.int64()), pa.array(node), pa.array(check),
                                              items, pa.array(bits, pa.binary())], ["n", "node", "check", "items", "bits"])

    return docs.select("text").mapInArrow(run, "n long, node long, check long, items array<long>, bits binary")


class SignatureTree:
    """Leaves are documents (bitmap, size, component); a node has the OR of its children and their ranges."""

    def __init__(self, maps: np.ndarray, size: np.ndarray, comp: np.ndarray):
        extra = size - np.bitwise_count(maps).sum(1)  # shingles that share a bit with another one
        self.levels = [(maps, size, size, extra, comp, comp)]
        while len(self.levels[-1][0]) > 1:
            maps, small, large, extra, c0, c1 = self.levels[-1]
            at = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at),
                                np.maximum.reduceat(extra, at), np.minimum.reduceat(c0, at), np.maximum.reduceat(c1, at)))


def tree_pairs(a: SignatureTree, b: SignatureTree, percent: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of leaves (i of ``a``, j of ``b``) whose possible overlap reaches the threshold, and that overlap.

    Leaves of one component are left out; with ``same`` the trees are one, and i < j.
    """
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    i, j, best = np.zeros(1, np.int64), np.zeros(1, np.int64), None
    while True:
        (ma, sa, xa, ea, a0, a1), (mb, sb, xb, eb, b0, b1) = a.levels[la], b.levels[lb]
        keep_i, keep_j, keep_best = [], [], []
        step = max(1, (1 << 19) // ma.shape[1])
        for s in range(0, len(i), step):  # bounded memory
            p, q = i[s:s + step], j[s:s + step]
            ok = (100 * xa[p] >= percent * sb[q]) & (100 * xb[q] >= percent * sa[p])
            ok &= ~((a0[p] == a1[p]) & (b0[q] == b1[q]) & (a0[p] == b0[q]))
            p, q = p[ok], q[ok]
            most = np.bitwise_count(ma[p] & mb[q]).sum(1) + np.minimum(ea[p], eb[q])
            most = np.minimum(most, np.minimum(xa[p], xb[q]))
            ok = (100 + percent) * most >= percent * (sa[p] + sb[q])
            keep_i.append(p[ok])
            keep_j.append(q[ok])
            keep_best.append(most[ok])
        i, j, best = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keep_i, keep_j, keep_best))
        if la == 0 and lb == 0:
            ok = i < j if same else np.ones(len(i), bool)
            return i[ok], j[ok], best[ok]
        if la >= lb:
            i, j = _down(i, j, len(a.levels[la - 1][0]))
            la -= 1
            if same:
                j, i = _down(j, i, len(b.levels[lb - 1][0]))
                lb -= 1
                ok = i <= j
                i, j = i[ok], j[ok]
        else:
            j, i = _down(j, i, len(b.levels[lb - 1][0]))
            lb -= 1


def _down(i: np.ndarray, other: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Replace each node by its children."""
    child = (i[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    ok = child < n
    return child[ok], np.repeat(other, FANOUT)[ok]


def _leaf_pairs(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of a block that the walk of its trees leaves, and the overlap that is possible."""
    side = table.column("side").to_numpy()
    node, n, comp = (table.column(c).to_numpy() for c in ("node", "n", "comp"))
    words = [np.frombuffer(x, np.uint64) for x in table.column("bits").to_pylist()]
    width = min(len(w) for w in words)
    trees, order = [], []
    for s in np.unique(side):
        at = np.flatnonzero(side == s)
        at = at[np.lexsort((node[at], n[at], comp[at]))]
        order.append(at)
        trees.append(SignatureTree(np.stack([fold(words[x], width) for x in at]), n[at], comp[at]))
    if len(trees) == 1 and side[0] == 1:  # the other block of the pair has no row
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j, most = tree_pairs(trees[0], trees[-1], percent, same=len(trees) == 1)
    i, j = order[0][i], order[-1][j]
    ok = node[i] != node[j]
    return i[ok], j[ok], most[ok]


def _pairs_of_two(table: pa.Table, begin: np.ndarray, two: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for all blocks of two rows (of equal widths) at once: they are most of the blocks."""
    node, n, comp = (table.column(c).to_numpy() for c in ("node", "n", "comp"))
    size = binary_sizes(table, "bits")
    bits = table.column("bits").combine_chunks()
    out = [(np.zeros(0, np.int64),) * 3]
    for width in np.unique(size[begin[two]]):
        i = begin[two & (size[begin] == width)]
        j = i + 1
        a, b = (np.frombuffer(b"".join(bits.take(pa.array(x)).to_pylist()), np.uint64).reshape(len(x), -1) for x in (i, j))
        extra = np.minimum(n[i] - np.bitwise_count(a).sum(1), n[j] - np.bitwise_count(b).sum(1))
        most = np.minimum(np.bitwise_count(a & b).sum(1) + extra, np.minimum(n[i], n[j]))
        ok = (comp[i] != comp[j]) & (node[i] != node[j]) & ((100 + percent) * most >= percent * (n[i] + n[j]))
        out.append((i[ok], j[ok], most[ok]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _of_blocks(table: pa.Table, begin: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of ``table`` that the walks leave: the blocks of two first, then one block after the other."""
    if not table.num_rows:
        return
    end = np.append(begin[1:], table.num_rows)
    size = binary_sizes(table, "bits")
    two = (end - begin == 2) & (size[begin] == size[np.minimum(begin + 1, table.num_rows - 1)])
    yield _pairs_of_two(table, begin, two, percent)
    for x, y in zip(begin[~two].tolist(), end[~two].tolist()):
        if y - x > 1:
            i, j, most = _leaf_pairs(table.slice(x, y - x), percent)
            yield i + x, j + x, most


def _best(groups: DataFrame, percent: int) -> DataFrame:
    """Of each node and block its most promising smaller partner (u, v, score): one row per member at most.

    A group of more than BLOCK_ROWS is cut into blocks by a hash of the node; each block holds the
    smallest node of its group too, which joins the blocks.
    """
    size = groups.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("head"))
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    g = groups.join(size, "key").withColumn("blocks", blocks)
    places = F.when(F.col("node") == F.col("head"), F.sequence(F.lit(0), F.col("blocks") - 1)) \
        .otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    g = g.select("key", "node", "n", "bits", "comp", F.explode(places).alias("x")).withColumn("y", F.lit(0)).withColumn("side", F.lit(0))

    def each(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, n = (table.column(c).to_numpy() for c in ("node", "n"))
        for i, j, most in _of_blocks(table, begin, percent):
            u, v = np.where(node[i] < node[j], j, i), np.where(node[i] < node[j], i, j)
            score = most / np.maximum(1, n[u] + n[v] - most)
            rank = np.lexsort((node[v], -score, u))
            u, v, score = u[rank], v[rank], score[rank]
            ok = np.concatenate(([True], u[1:] != u[:-1])) if len(u) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(node[u[ok]]), pa.array(node[v[ok]]), pa.array(score[ok], pa.float64())], ["u", "v", "score"])

    return walk(g, each, "u long, v long, score double", "jaccard")


def _alive(placed: DataFrame, percent: int) -> DataFrame:
    """Members (key, node) that the trees leave a partner of another component: only their sets need to be looked at."""

    def each(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, node = (table.column(c).to_numpy() for c in ("key", "node"))
        for i, j, _ in _of_blocks(table, begin, percent):
            at = np.unique(np.concatenate((i, j)))
            yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(node[at])], ["key", "node"])

    return walk(placed, each, "key long, node long", "jaccard")


def _block_links(placed: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between components, verified on the whole sets where the trees leave a pair: fewer than a block has rows."""

    def each(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        for x, y in spans(begin, table.num_rows):
            if y - x > 1:
                block = table.slice(x, y - x)
                i, j, _ = _leaf_pairs(block, percent)
                yield links(block, i, j, percent)

    return walk(placed, each, "u long, v long", "jaccard")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) of set ids: the pairs of nodes whose whole sets reach the threshold."""
    a = sets.select(F.col("node").alias("u"), F.col("id").alias("du"), F.col("items").alias("iu"))
    b = sets.select(F.col("node").alias("v"), F.col("id").alias("dv"), F.col("items").alias("iv"))
    both = F.size(F.array_intersect("iu", "iv"))
    return (pairs.join(a, "u").join(b, "v").withColumn("both", both)
            .where(100 * F.col("both") >= percent * (F.size("iu") + F.size("iv") - F.col("both")))
            .select(F.col("du").alias("u"), F.col("dv").alias("v")))


def classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash (of the text), n_shingles, class (null if the set is empty), component_id, first.

    ``first`` marks the row that stands for its class: the smallest doc_id (null last), then text_hash.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    with_keys = written(signatures(docs, k, percent), "signatures")
    table = written(with_keys.drop("keys"), "sets-of-documents")
    real = table.where("n > 0").select("doc_id", "text_hash", "n", "node", "check")
    where = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    reps = written(real.groupBy("node", "check", "n").agg(F.min(where).alias("r"))
                   .select(F.monotonically_increasing_id().alias("id"), "node", "check", "n", "r.doc_id", "r.text_hash"), "nodes")

    rows = with_keys.where("n > 0").select(F.explode("keys").alias("key"), "node")
    many = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = written(rows.join(many, "key", "left_semi").distinct(), "members")
    dropped(with_keys)  # the largest table between; nothing reads it any more
    # groups of the same nodes are one: the smallest key stays
    half = F.lit(1 << 40)
    tagged = members.groupBy("key").agg(F.sum(F.pmod(F.xxhash64("node"), half)).alias("a"),
                                        F.sum(F.pmod(F.xxhash64("node", F.lit(7)), half)).alias("b"),
                                        F.count(F.lit(1)).alias("c"), F.min("node").alias("m"))
    chosen = tagged.groupBy("a", "b", "c", "m").agg(F.min("key").alias("key")).select("key")
    all_members, members = members, written(members.join(chosen, "key", "left_semi"), "groups")
    dropped(all_members)

    wanted = reps.join(members.select("node").distinct(), "node", "left_semi").select("doc_id", "text_hash").distinct()
    both = F.expr("doc_id <=> __d and text_hash <=> __t")
    wanted = wanted.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"))
    sets = _sets(docs.join(wanted, both, "left_semi"), k)
    sets = written(sets.join(reps.select("node", "check", "n", "id"), ["node", "check", "n"]).dropDuplicates(["id"])
                   .select("id", "node", "n", "items", "bits"), "sets")

    brief = table.select("node", "n", "brief").groupBy("node", "n").agg(F.first("brief").alias("bits"))
    groups = members.join(brief, "node").withColumn("comp", F.col("node"))
    pairs = _best(groups, percent).groupBy("u").agg(F.max_by("v", F.struct("score", "v")).alias("v"))
    comp = components(written(_verified(pairs, sets, percent), "links"))
    comp = completed(members, sets, comp, components, lambda g: _alive(g, percent), lambda g: _block_links(g, percent), ["bits"], ["items", "bits"])

    least = reps.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("class", F.coalesce("component", "id"))
    least = written(least.select("node", "check", "n", "class", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash").alias("r")), "classes")
    top = least.groupBy("class").agg(F.min("r").alias("top")).select("class", F.col("top.doc_id").alias("component_id"), F.col("top.text_hash").alias("h"))
    linked = real.join(least.drop("r").join(top, "class"), ["node", "check", "n"]) \
        .select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "class", "component_id",
                F.expr("doc_id <=> component_id and text_hash <=> h").alias("first"))
    alone = table.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("class"),
                                        F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return linked.unionByName(alone)


def similar(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    return classes(docs, k, percent).select("doc_id", "n_shingles", "component_id")


def kept(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their class; rows of one doc_id and one text go or stay together."""
    gone = written(classes(docs, k, percent).where("not first")
                   .select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct(), "near-gone")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__d"]) & F.xxhash64(docs["text"]).eqNullSafe(gone["__t"]), "left_anti")
