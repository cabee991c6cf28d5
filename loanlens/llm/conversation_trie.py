"""Prefix trie of conversations: ternary search trees per range shard, merged at their boundary nodes.

1. Turns (role, text) become ids of a dictionary; a conversation is the array of its ids.
2. The arrays are sorted over range shards.  A run of at most BLOCK_TURNS turns of a shard is a
   ternary search tree, balanced by inserting the median of its distinct arrays first.  An iterative
   traversal sums members, leaves and savings from the leaves up.
3. Only the nodes on the paths of the first and the last array of a block can lie in a neighbour
   too.  All other nodes are whole and leave as result rows.  A block hands on its two paths, with
   what hangs below them already summed up; runs of neighbouring paths are folded the same way,
   thousands at a time, until one fold holds all.
4. Members that end at a boundary node leave as pieces of text in order, hashed as a stream.  A
   node whose parent is a boundary node takes the parent's name from the merged paths, by block, so the root
   is no hot key.

Hot conversations (equal arrays) are dealt by conv_id too and so lie in many blocks; no task holds
more than a block or a fold.  One conversation is one row: an id and a word count per turn.

Defined results: rows without a conv_id are in no conversation; a null role or text is empty; turns
are in the order of ``turn``, null first, and ties by SHA-256 of role and text; repeated rows are
turns each.  An empty table has no node, not even a root.  Columns but conv_id, turn, role and
text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loanlens.llm.store import dropped, written
from loanlens.llm.text import tidied

FAMILY, SHARED = 20, 4  # conversations of a family, and one more than the turns that they can share
BLOCK_TURNS, BLOCK_ROWS = 1 << 17, 1 << 15  # of a search tree
FOLD = 2048  # paths of a fold
_EMPTY = hashlib.sha256(b"").hexdigest()
_NONE = (1 << 63) - 1
_WORD = r"[^\x20\x09-\x0D]+"
_SCHEMA = pa.schema([
    ("kind", pa.string()), ("at", pa.int64()), ("key", pa.binary()), ("pkey", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends", pa.string()), *[(c, pa.list_(pa.int64())) for c in ("ids", "words", "cnt", "least", "kids", "leaves", "saved")]])
_DDL = ("kind string, at long, key binary, pkey binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends string, " + ", ".join(f"{c} array<long>" for c in ("ids", "words", "cnt", "least", "kids", "leaves", "saved")))


def encoded(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, id, words: each turn with its id in the dictionary of distinct (role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"))
    turns = written(turns, "trie-turns")
    dictionary = written(turns.groupBy("digest").agg(F.first("words").alias("words"))
                         .select("digest", F.monotonically_increasing_id().alias("id")), "trie-dictionary")
    return turns.join(dictionary, "digest")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, ids, words: conversation c begins with the first h turns of c - c % 20, h = crc32(c) % 4, and goes on with its own after h.

    The conversations of a family lie together, so the shuffle that gathers the turns serves both.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    turn = F.struct(F.col("turn").isNotNull().alias("f"), "turn", "digest", "id", "words")
    own = turns.withColumn("base", base).repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    own = own.withColumn("t", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))))
    head = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("t", 1, SHARED - 1)), ignorenulls=True).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    own = own.withColumn("head", F.coalesce(head, F.slice("t", 1, 0))).withColumn("h", h)
    t = F.concat(F.slice("head", F.lit(1), F.col("h")), F.slice("t", F.col("h") + 1, F.greatest(F.size("t") - F.col("h"), F.lit(0))))
    own = own.withColumn("t", t)
    return own.select("conv_id", F.transform("t", lambda x: x["id"]).alias("ids"), F.transform("t", lambda x: x["words"]).alias("words"))


def _keys(ids: list[int]) -> list[bytes]:
    """A name of each prefix of a path, from the root on."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for x in ids:
        h.update(x.to_bytes(8, "little", signed=True))
        out.append(h.digest())
    return out


def _common(a: list[int], b: list[int]) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class Rows:
    """Result rows gathered by column, given out as record batches."""

    def __init__(self) -> None:
        self.rows: list[dict] = []

    def add(self, kind: str, **values) -> None:
        self.rows.append({"kind": kind, **values})

    def batches(self) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(self.rows), 20_000):
            some = self.rows[s:s + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in some], f.type) for f in _SCHEMA], schema=_SCHEMA)
        self.rows = []


class SearchTree:
    """A ternary search tree over arrays of ids; ``keys`` are distinct and sorted, the median goes in first."""

    def __init__(self, keys: list[list[int]]):
        self.id: list[int] = []
        self.low: list[int] = []
        self.same: list[int] = []
        self.high: list[int] = []
        self.key: list[int] = []  # the array that ends here
        self.top, self.empty = -1, -1
        todo = [(0, len(keys))]
        while todo:
            a, b = todo.pop()
            if a < b:
                mid = (a + b) // 2
                self._insert(keys[mid], mid)
                todo += [(a, mid), (mid + 1, b)]

    def _new(self, x: int) -> int:
        self.id.append(x)
        for side in (self.low, self.same, self.high, self.key):
            side.append(-1)
        return len(self.id) - 1

    def _insert(self, key: list[int], k: int) -> None:
        if not key:
            self.empty = k
            return
        at, side, own = -1, None, self.top
        for x in key:
            if own < 0:
                own = self._new(x)
                if side is None:
                    self.top = own
                else:
                    side[at] = own
            while self.id[own] != x:
                nxt = self.low if x < self.id[own] else self.high
                if nxt[own] < 0:
                    nxt[own] = self._new(x)
                own = nxt[own]
            at, side = own, self.same
            own = self.same[own]
        self.key[at] = k

    def nodes(self) -> tuple[list[int], list[int]]:
        """Tree nodes in an order with parents first, and the place of each one's parent in it (-1: the root)."""
        order, parent, todo = [], [], [(self.top, -1)]
        while todo:
            node, up = todo.pop()
            if node >= 0:
                todo += [(self.low[node], up), (self.high[node], up), (self.same[node], len(order))]
                order.append(node)
                parent.append(up)
        return order, parent


def _ends(convs: list[int]) -> str:
    return ",".join(map(str, convs))


def block_rows(at: int, arrays: list[list[int]], words: list[list[int]], convs: list[int], out: Rows) -> None:
    """Nodes, paths, pieces and references of one block of sorted conversations, named ``at``."""
    keys, begin = [], []
    for i, ids in enumerate(arrays):
        if not keys or ids != keys[-1]:
            keys.append(ids)
            begin.append(i)
    begin.append(len(arrays))
    tree = SearchTree(keys)
    order, parent = tree.nodes()
    n = len(order) + 1  # the root is the last
    parent = [p if p >= 0 else n - 1 for p in parent] + [-1]
    term = [tree.key[t] for t in order] + [tree.empty]
    depth, cost = [0] * n, [0] * n
    boundary = [False] * n
    place = {t: i for i, t in enumerate(order)}
    paths = []
    for ids in (keys[0], keys[-1]):  # the two boundary paths
        path, own = [n - 1], tree.top
        for x in ids:
            while tree.id[own] != x:
                own = tree.low[own] if x < tree.id[own] else tree.high[own]
            path.append(place[own])
            own = tree.same[own]
        paths.append(path)
        for i in path:
            boundary[i] = True
    for i in range(n - 1):
        depth[i] = depth[parent[i]] + 1
    members, least = [0] * n, [_NONE] * n
    kids, leaves, saved = [0] * n, [0] * n, [0] * n
    for i, k in enumerate(term):
        if k >= 0:
            members[i], least[i] = begin[k + 1] - begin[k], convs[begin[k]]
            line, up = words[begin[k]], i
            for d in range(depth[i], 0, -1):  # words of the turns above, as far as not known
                if cost[up]:
                    break
                cost[up], up = line[d - 1], parent[up]
    for i in [*range(n - 2, -1, -1)]:
        p = parent[i]
        members[p] += members[i]
        least[p] = min(least[p], least[i])
        if not boundary[i]:
            own = (members[i] - 1) * cost[i] + saved[i]
            leaves[i] = leaves[i] if kids[i] else 1
            saved[i] = own
            kids[p] += 1
            leaves[p] += leaves[i]
            saved[p] += own
    names = {}
    for ids, path in zip((keys[0], keys[-1]), paths):
        names.update(zip(path, _keys(ids)))
    refs = set()
    for i in range(n):
        k, p = term[i], parent[i]
        if boundary[i] and k >= 0:
            out.add("piece", at=at, key=names[i], ends=_ends(convs[begin[k]:begin[k + 1]]))
        elif not boundary[i]:
            sha = _EMPTY if k < 0 else hashlib.sha256(_ends(convs[begin[k]:begin[k + 1]]).encode()).hexdigest()
            if boundary[p]:
                refs.add(names[p])
            out.add("node", at=at, pkey=names.get(p), conv_id=least[i], depth=depth[i], parent_conv_id=None if boundary[p] else least[p],
                    n_convs=members[i], n_children=kids[i], n_leaves=leaves[i], saved_tokens=saved[i], ends=sha)
    for key in refs:
        out.add("ref", at=at, key=key)
    shared = _common(keys[0], keys[-1]) + 1
    for last, (ids, path, k) in enumerate(zip((keys[0], keys[-1]), paths, (0, len(keys) - 1))):
        if last and len(keys) == 1:
            break
        new = [not last or d >= shared for d in range(len(path))]
        line = words[begin[k]]
        out.add("path", at=2 * at + last, ids=ids, words=line, cnt=[members[i] * x for i, x in zip(path, new)],
                least=[least[i] if x else _NONE for i, x in zip(path, new)], kids=[kids[i] * x for i, x in zip(path, new)],
                leaves=[leaves[i] * x for i, x in zip(path, new)], saved=[saved[i] * x for i, x in zip(path, new)])


def _trees(sorted_arrays: DataFrame) -> DataFrame:
    """Rows of all blocks of sorted (conv_id, ids, words)."""

    @tidied("conversation_trie")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, shard, number = Rows(), TaskContext.get().partitionId(), 0
        arrays: list[list[int]] = []
        words: list[list[int]] = []
        convs: list[int] = []
        turns = 0
        for batch in batches:
            for conv, ids, line in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "words"))):
                if arrays and (turns + len(ids) > BLOCK_TURNS or len(arrays) >= BLOCK_ROWS):
                    block_rows((shard << 28) + number, arrays, words, convs, out)
                    yield from out.batches()
                    arrays, words, convs, turns, number = [], [], [], 0, number + 1
                arrays.append(ids)
                words.append(line)
                convs.append(conv)
                turns += len(ids)
        if arrays:
            block_rows((shard << 28) + number, arrays, words, convs, out)
            yield from out.batches()

    return sorted_arrays.mapInArrow(run, _DDL)


class Open:
    """A node of the path that a fold is on: sums so far, and its finished children, which wait for its name."""

    __slots__ = ("id", "words", "cnt", "least", "kids", "leaves", "saved", "first", "children")

    def __init__(self, x: int, words: int, first: bool):
        self.id, self.words, self.first = x, words, first
        self.cnt, self.least, self.kids, self.leaves, self.saved = 0, _NONE, 0, 0, 0
        self.children: list[dict] = []


def _fold(paths: Iterator[dict], at: int, last: bool, out: Rows) -> None:
    """Merge sorted boundary paths; nodes that no other fold shares leave as rows.

    Unless it is the ``last`` one, the nodes on the fold's own first and last path go on as paths.
    """
    stack: list[Open] = []
    begun: list[Open] = []  # nodes of the first path
    first_ids: list[int] | None = None
    first_words: list[int] = []
    names: list[bytes] = []
    refs: set[bytes] = set()

    def given(node: Open, name: bytes, conv: int | None) -> None:
        for child in node.children:
            out.add("node", at=at, pkey=name if conv is None else None, parent_conv_id=conv, **child)
            if conv is None:
                refs.add(name)
        node.children = []

    def close() -> None:
        node = stack.pop()
        if node.first and not last:
            return
        name, depth = names.pop(), len(stack)
        given(node, name, node.least)
        leaves = node.leaves if node.kids else 1
        saved = node.saved + (node.cnt - 1) * node.words
        row = dict(key=name, conv_id=node.least, depth=depth, n_convs=node.cnt, n_children=node.kids, n_leaves=leaves, saved_tokens=saved)
        if not stack:
            out.add("node", at=at, **row)
            return
        up = stack[-1]
        up.kids += 1
        up.leaves += leaves
        up.saved += saved
        up.children.append(row)

    for item in paths:
        ids, words = item["ids"], item["words"]
        same = 0
        if first_ids is None:
            first_ids, first_words = ids, words
            stack.append(Open(0, 0, True))
        else:
            here = [x.id for x in stack[1:]]
            same = _common(here, ids)
        while len(stack) > same + 1:
            close()
        own = _keys(ids)
        names[:] = own
        for d in range(same, len(ids)):
            stack.append(Open(ids[d], words[d], ids is first_ids))
        if ids is first_ids:
            begun = list(stack)
        for d, node in enumerate(stack):
            if item["cnt"][d] or item["kids"][d]:
                node.cnt += item["cnt"][d]
                node.least = min(node.least, item["least"][d])
                node.kids += item["kids"][d]
                node.leaves += item["leaves"][d]
                node.saved += item["saved"][d]
        tail_ids, tail_words = ids, words
    if first_ids is None:
        return
    if last:
        while stack:
            close()
        return

    def path(nodes: list[Open], mark: int, ids: list[int], words: list[int], new: list[bool]) -> None:
        key = _keys(ids)
        for node, name, x in zip(nodes, key, new):
            if x:
                given(node, name, None)
        out.add("path", at=2 * at + mark, ids=ids, words=words, cnt=[v.cnt * x for v, x in zip(nodes, new)],
                least=[v.least if x else _NONE for v, x in zip(nodes, new)], kids=[v.kids * x for v, x in zip(nodes, new)],
                leaves=[v.leaves * x for v, x in zip(nodes, new)], saved=[v.saved * x for v, x in zip(nodes, new)])

    path(begun, 0, first_ids, first_words, [True] * len(begun))
    if len(stack) > 0 and any(not v.first for v in stack) or tail_ids != first_ids:
        path(list(stack), 1, tail_ids, tail_words, [not v.first for v in stack])
    for name in refs:
        out.add("ref", at=at, key=name)


def _folded(paths: DataFrame, parts: int, level: int) -> DataFrame:
    """One fold per range of paths; the last one, over all of them, leaves no path."""
    final = parts == 1

    @tidied("conversation_trie")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = Rows()
        # blocks have names of 2**28 and more per shard; folds are named apart from them, in order of their shard
        _fold((row for b in batches for row in b.to_pylist()), (level << 56) + TaskContext.get().partitionId(), final, out)
        yield from out.batches()

    slim = paths.select("at", "ids", "words", "cnt", "least", "kids", "leaves", "saved")
    dealt = slim.repartition(1) if final else slim.repartitionByRange(parts, "at")
    return dealt.sortWithinPartitions("at").mapInArrow(run, _DDL)


def _hashed(pieces: DataFrame) -> DataFrame:
    """(key, sha): SHA-256 of the pieces of each key, joined by commas in order, as a stream."""

    @tidied("conversation_trie")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "sha"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "sha"])

    return pieces.repartition("key").sortWithinPartitions("key", "at").mapInArrow(run, "key binary, sha string")


def trie(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    arrays = written(rebuilt(encoded(conversations)), "trie-arrays")
    size = arrays.agg(F.sum(F.size("ids") + 1).alias("turns")).first()["turns"] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (4 * BLOCK_TURNS)))
    parts = [written(_trees(arrays.repartitionByRange(shards, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")), "trie-blocks")]
    level = 0
    while True:
        level += 1
        paths = parts[-1].where("kind = 'path'")
        n = paths.count()
        runs = 1 if n <= 2 * FOLD else -(-n // FOLD)
        parts.append(written(_folded(paths, runs, level), "trie-folds"))
        if runs == 1:
            break
    dropped(arrays)

    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    nodes = rows.where("kind = 'node'")
    merged = nodes.where("key is not null").select("key", F.col("conv_id").alias("up"))
    named = written(rows.where("kind = 'ref'").select("at", "key").join(merged, "key").select("at", F.col("key").alias("pkey"), "up"), "trie-names")
    sha = written(_hashed(rows.where("kind = 'piece'").select("key", "at", "ends")), "trie-ends")
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = nodes.select(*result, "at", "key", "pkey", "ends")
    out = nodes.where("pkey is null").unionByName(
        nodes.where("pkey is not null").join(named, ["at", "pkey"]).withColumn("parent_conv_id", F.col("up")).drop("up"), allowMissingColumns=True)
    whole = out.where("key is null").select(*result, F.col("ends").alias("ends_sha256"))
    boundary = out.where("key is not null").join(sha, "key", "left").select(*result, F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"))
    return whole.unionByName(boundary)


TRIE_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
e AS (SELECT conv_id, turn, sha256(length(r)::VARCHAR || ':' || r || x) AS d, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM t),
o AS (SELECT conv_id, list({'d': d, 'w': w} ORDER BY turn NULLS FIRST, d) AS t FROM e GROUP BY conv_id),
k AS (SELECT conv_id, t, xor(4294967295, list_reduce(
        list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END)) % 4 AS h FROM o),
b AS (SELECT k.conv_id, list_concat(list_slice(coalesce(p.t, []), 1, k.h), list_slice(k.t, k.h + 1, len(k.t))) AS t
      FROM k LEFT JOIN o p ON p.conv_id = k.conv_id - k.conv_id % 20),
v AS (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM b),
m AS (SELECT conv_id, d, len(t) = d AS last, CASE WHEN d = 0 THEN 0 ELSE t[d].w END AS w,
             md5(array_to_string(list_transform(list_slice(t, 1, d), lambda x: x.d), ',')) AS k FROM v),
n AS (SELECT d, k, min(conv_id) AS c, count(*) AS n, any_value(w) AS w,
             string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last) AS ends FROM m GROUP BY d, k),
own AS (SELECT m.conv_id, m.d, n.c FROM m JOIN n USING (d, k)),
q AS (SELECT n.*, p.c AS pc FROM n LEFT JOIN own p ON p.conv_id = n.c AND p.d = n.d - 1),
kids AS (SELECT d - 1 AS d, pc AS c, count(*) AS n_children FROM q WHERE d > 0 GROUP BY ALL),
f AS (SELECT q.*, coalesce(kids.n_children, 0) AS n_children FROM q LEFT JOIN kids ON kids.d = q.d AND kids.c = q.c),
s AS (SELECT a.d, a.c, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n - 1) * f.w) AS saved
      FROM f JOIN own a ON a.conv_id = f.c AND a.d <= f.d GROUP BY ALL)
SELECT f.c AS conv_id, f.d AS depth, f.pc AS parent_conv_id, f.n AS n_convs, f.n_children, s.n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN s ON s.d = f.d AND s.c = f.c"""
