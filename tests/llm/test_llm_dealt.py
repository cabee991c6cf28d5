"""MinHash near duplicates, the conversation trie and the fill-in-the-middle transformation against brute force, on small tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from conftest import SMALL
from loanlens.llm import blocks, conversation_trie, fill_middle, minhash, queries, star_components, store

WORDS = re.compile("[^\x20\x09-\x0d]+")
SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# -- 11: MinHash


def minhash_brute(rows, k, percent):
    sets = []
    for _, text in rows:
        words = WORDS.findall(lower(text))
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()})
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((str(d), len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(spark, rows, k, percent):
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in out), key=str)


def planted(rng, n, edits):
    base = [f"w{rng.randint(0, 9999)}" for _ in range(100)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(100)] = f"z{rng.randint(0, 10 ** 6)}"
        out.append((i, " ".join(words)))
    return out


def test_minhash_components_of_documents(spark):
    rng = random.Random(2)
    rows = [(r.doc_id, r.text) for r in store.documents(spark, SMALL).select("doc_id", "text").collect()]
    base = [t for _, t in rows if t and len(t) < 4000]
    for at in range(10_000, 10_060):
        words = rng.choice(base[:20]).split(" ")[:200]
        for _ in range(rng.randint(0, max(1, len(words) // 40))):
            words[rng.randrange(len(words))] = f"zz{rng.randint(0, 9)}"
        rows.append((at, "\n".join(words)))
    rows += [(50_000, None), (50_001, ""), (50_002, "a " * 70), (50_003, "A  b"), (50_004, "a b"), (50_005, "ab")]
    assert found(spark, rows, 5, 85) == minhash_brute(rows, 5, 85)


@pytest.mark.parametrize("rows_of_block", [16, 4096])
def test_minhash_on_a_large_group_of_near_copies(spark, monkeypatch, rows_of_block):
    """Chains of small differences, in one block and crossed ones; no table between grows with the pairs."""
    monkeypatch.setattr(blocks, "ROWS", rows_of_block)
    rows, sizes = planted(random.Random(6), 250, 5), {}

    def counted(df, name):
        out = store.written(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(minhash, "written", counted)
    monkeypatch.setattr(blocks, "written", counted)
    assert found(spark, rows, 5, 85) == minhash_brute(rows, 5, 85)
    assert max(sizes.values()) <= minhash.BANDS * len(rows)


def test_minhash_takes_awkward_rows(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (2, a), (2, b), (2, b), (None, b + " x"), (None, None), (3, " \n\t"), (4, "x"), (5, "X"), (6, "long words of a text " * 8000)]
    assert found(spark, rows, 5, 85) == minhash_brute(rows, 5, 85)
    assert found(spark, [], 5, 85) == []


def test_minima_are_those_of_each_set():
    rng = np.random.RandomState(1)
    sets = [np.unique(rng.randint(0, 2**62, n)).astype(np.uint64) for n in (5, 0, 1, 40_000, 3, 0)]
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    got = minhash.minima(np.concatenate(sets), first)
    a, b = minhash._hashes()
    for s, row in zip(sets, got):
        want = [(s * a[h] + b[h]).min() if len(s) else ~np.uint64(0) for h in range(len(a))]
        assert (row == minhash.mix(np.array(want, np.uint64))).all()
    share = np.mean([(minhash.minima(np.concatenate((s[:900], s[:800], t)), np.array([0, 900, 1700 + len(t)]))[:2] ==
                      minhash.minima(s[:900], np.array([0, 900]))[0])[1].mean()
                     for s, t in [(np.unique(rng.randint(0, 2**62, 1000)).astype(np.uint64), np.unique(rng.randint(0, 2**62, 60)).astype(np.uint64)) for _ in range(20)]])
    assert abs(share - 800 / 960) < 0.03  # an unbiased estimate of the similarity


def test_star_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2200)] + [(5, 5)]
    up = {x: x for e in edges for x in e if e[0] != e[1]}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    got = star_components.components(spark.createDataFrame(edges + [(None, 3)], "u long, v long"))
    assert {r.node: r.component for r in got.collect()} == {x: top(x) for x in up}
    assert star_components.components(spark.createDataFrame([], "u long, v long")).collect() == []


# -- 12: conversations


def trie_brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            r, t = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), SHA(f"{len(r)}:{r}{t}"), (r, t)))
    own = {c: [x[2] for x in sorted(t, key=lambda x: x[:2])] for c, t in turns.items()}
    nodes, ends = defaultdict(set), defaultdict(list)
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        t = tuple(own.get(c - c % 20, [])[:h] + t[h:])
        ends[t].append(c)
        for d in range(len(t) + 1):
            nodes[t[:d]].add(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[q] for q in kids[p]) + ((len(nodes[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0)
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   SHA(",".join(map(str, sorted(ends[p]))))) for p, m in nodes.items())


def trie(spark, rows):
    out = conversation_trie.trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    return sorted(tuple(r) for r in out.collect())


def talks(rng, n, words=4):
    out = []
    for c in rng.sample(range(10 * n), n):
        for turn in range(rng.randint(0, 6)):
            out.append((c, turn, rng.choice(["user", "assistant"]), " ".join(rng.choice("abc") for _ in range(rng.randint(0, words)))))
    return out


@pytest.mark.parametrize("block_turns, block_rows, fold", [(1 << 17, 1 << 15, 2048), (20, 4, 4), (1, 1, 7)])
def test_trie_equals_brute_force(spark, monkeypatch, block_turns, block_rows, fold):
    """Also with blocks of a few conversations and several levels of folds: hot nodes lie in many blocks."""
    monkeypatch.setattr(conversation_trie, "BLOCK_TURNS", block_turns)
    monkeypatch.setattr(conversation_trie, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(conversation_trie, "FOLD", fold)
    rng = random.Random(block_turns)
    rows = talks(rng, 120, 1)
    rows += [(c, t, "user", f"hot {t}") for c in range(5000, 5060) for t in range(5)]
    rng.shuffle(rows)
    assert trie(spark, rows) == trie_brute(rows)


def test_trie_takes_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (None, 1, "user", "x"), (7, 2, "", "  "), (3, 1, "user", "one"),
            (40, 1, "user", "w " * 20_000), (44, 1, "us", "erx"), (45, 1, "user", "x"), (60, 1, "a", "b"), (60, 3, "a", "c"), (61, 1, "q", "r"), (62, 9, "q", "r")]
    assert trie(spark, rows) == trie_brute(rows)
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "a", "b")]) == []
    extra = spark.createDataFrame([(1, 0, "user", "a", 5, "k", 1)], "conv_id long, turn int, role string, text string, depth long, key string, id long")
    assert conversation_trie.trie(extra).count() == len(trie_brute([(1, 0, "user", "a")]))


def test_trie_of_a_long_conversation(spark):
    rows = [(c, t, "user", f"{t}") for c in (100, 118) for t in range(3000)]
    assert trie(spark, rows) == trie_brute(rows)


def test_search_tree_is_balanced():
    keys = sorted([i] for i in range(1023))
    tree = conversation_trie.SearchTree(keys)

    def deep(t):
        return 0 if t < 0 else 1 + max(deep(tree.low[t]), deep(tree.high[t]))

    assert deep(tree.top) == 10


# -- 13: fill in the middle


UNITS = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def fim_brute(doc_id, text):
    text = text or ""
    u = UNITS.findall(text)
    n, h = len(u), SHA(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[x:x + 8], 16) for x in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", text, None, None
    if h4 % 100 < 20:
        return n, "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return n, "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def awkward_texts():
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefgh  é日😀.\n") for _ in range(6000))
    out = [None, "", "a", " ", "<P>", "x<S>y", "<<P", "<S", "a" * 50_000, "é" * 20_000, "ab " * 30_000, "日本語" * 9000, "\x00\x7f<M", "😀" * 5]
    out += [passage, passage + "z", "q" + passage, passage[100:5000] + passage, "word " * 3 + passage * 3]
    return out + ["".join(rng.choice("abAZ @[`{<PSM>é日😀\n") for _ in range(rng.randint(0, 3000))) for _ in range(120)]


@pytest.mark.parametrize("cache", [32 << 20, 4000])
def test_fill_middle_equals_brute_force(spark, monkeypatch, cache):
    monkeypatch.setattr(fill_middle, "CACHE_BYTES", cache)
    rows = list(enumerate(awkward_texts())) + [(None, "no id here"), (None, None), (3, "again a"), (3, "again a")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = fill_middle.transform(table).select("*", fill_middle.restored().alias("back")).collect()
    want = sorted(((d, *fim_brute(d, t), t or "") for d, t in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    forms = {r.form for r in got}
    assert forms == {"plain", "psm", "spm"}
    assert fill_middle.digests(table.limit(0)).collect() == []


def test_fill_middle_takes_other_rates_and_clashing_columns(spark):
    table = spark.createDataFrame([(i, "some words of a text", "x", 1) for i in range(40)], "doc_id long, text string, form string, n long")
    assert {r.form for r in fill_middle.transform(table, rate=100, spm_rate=100).collect()} == {"spm"}
    assert {r.form for r in fill_middle.transform(table, rate=0).collect()} == {"plain"}
    assert len({r.output for r in fill_middle.transform(table, seed=2, rate=100).collect()}) > 5


def test_shared_passages_share_chunks():
    """Chunks inside a passage are the same wherever it stands, so a text costs the cache its own chunks only."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    cache = fill_middle.ChunkCache()

    def chunks(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        ends, _ = fill_middle.chunk_ends(raw, np.array([0, len(raw)]))
        assert max(np.diff([0, *ends])) <= fill_middle.LONG + 3
        return [text[a:b].encode() for a, b in zip([0, *ends], ends)]

    cache.summaries(chunks(passage))
    before = cache.held
    cache.summaries(chunks("another beginning " * 7 + passage))
    assert cache.held - before < 0.1 * before


def test_dealt_queries_over_whole_tables(spark):
    rows = store.documents(spark, SMALL).select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_fill_middle(spark, SMALL).collect()}
    for d, t in rows:
        n, form, output, prefix, middle = fim_brute(d, t)
        assert got[d] == (n, form, prefix, middle, SHA(output), SHA(t or ""))
    talk = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in queries.op12_conversation_trie(spark, SMALL).collect()) == trie_brute(talk)
    assert queries.op11_minhash(spark, SMALL).count() == len(rows)
