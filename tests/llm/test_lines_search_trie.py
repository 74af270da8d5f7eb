"""Line deduplication, ranked search and the prefix trie against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeline.llm import line_dedup, prefix_trie, ranked_search

DOCS = "doc_id long, text string, key string, keys string, owner string, n long, keep string"


def frame(spark, rows, parts=4):
    """Documents with extra columns whose names clash with columns of the operators."""
    return spark.createDataFrame([(i, t, "x", "x", "x", 7, "x") for i, t in rows], DOCS).repartition(parts)


# --- lines -----------------------------------------------------------------------------------------


def lines_by_force(rows, chars=40, docs=5):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= chars:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if i is None or len(h := holders.get(key(x), ())) < docs or i == max(h)]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(map(str, out))


def many_lines(rng):
    stock = [f"{'Äb' * rng.randrange(15, 25)} line {i}" for i in range(12)] + ["x" * 39, "é" * 40, "y" * 40]
    space = lambda: "".join(rng.choice(" \t\r\v\f") for _ in range(rng.randrange(3)))
    rows = []
    for i in range(60):
        lines = [space() + rng.choice([str.lower, str.upper, str])(rng.choice(stock)) + space() for _ in range(rng.randrange(6))]
        rows.append((i, "\n".join(lines + [f"own line of document {i} " * 3] * rng.randrange(2))))
    long = "\n".join(f"a very long text with line number {i % 5000} in it" for i in range(20_000))
    return rows + [(None, stock[0]), (None, None), (70, None), (71, ""), (72, "\n\n"), (73, long), (74, long), rows[5], rows[5], (5, stock[1])]


@pytest.mark.parametrize("bits", [64, 1 << 12, line_dedup.MAX_BITS])
def test_lines_equal_brute_force(spark, bits):
    """Also with filters so small that every line is suspected."""
    rows = many_lines(random.Random(3))
    got = line_dedup.drop_repeated_lines(frame(spark, rows), max_bits=bits)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted(str(tuple(r)) for r in got.collect()) == lines_by_force(rows)


def test_lines_of_few_documents_and_of_none(spark):
    rows = [(i, "the same long line in every one of these documents") for i in range(4)]
    assert {r.n_dropped for r in line_dedup.drop_repeated_lines(frame(spark, rows)).collect()} == {0}
    assert sum(r.n_dropped for r in line_dedup.drop_repeated_lines(frame(spark, rows), least_documents=2).collect()) == 3
    assert line_dedup.drop_repeated_lines(frame(spark, [])).count() == 0


def test_filters_of_tasks_miss_nothing():
    """A hash seen in two tasks, or twice in one, is in the merged twice-seen filter; most others are not."""
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = line_dedup.SeenFilters(1 << 18), line_dedup.SeenFilters(1 << 18)
    for part in np.split(hashes[:2000], 4):
        a.add(part)
    a.add(hashes[:100])
    b.add(hashes[1900:])
    once, twice = line_dedup._merge(np.stack([a.once, a.twice]), np.stack([b.once, b.twice]))
    at, masks = line_dedup._places(hashes, len(twice))
    held = twice[at] & masks == masks
    assert held[:100].all() and held[1900:2000].all() and held.sum() < 260
    assert (once[at] & masks == masks).all()


def test_key_takes_off_ascii_white_space_only():
    assert line_dedup.keys_of(" A\x1f \n B\v\n\t\u00a0") == [b"a\x1f", b"b", b"\xc2\xa0"]


# --- search ----------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})))


def search_by_force(docs, items, top=20):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_all = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(terms_of(text))
    out = []
    for item, own in asked.items():
        scores = []
        for i, c in counted:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_all
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in own.items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(map(str, out))


def search_rows(rng):
    words = [f"{a}{b}" for a in ("wo", "Zü", "é", "t9", "Q") for b in range(40)]
    pick = lambda n: rng.choice([" ", "-", "\n", "_"]).join(words[min(int(rng.expovariate(0.03)), 199)] for _ in range(n))
    docs = [(i, pick(rng.randrange(1, 60))) for i in range(400)]
    docs += [(i, docs[7][1]) for i in range(400, 460)]  # copies, so ties beyond the 20th
    docs += [(None, docs[3][1]), (500, None), (501, ""), (502, "!?"), (503, pick(40_000)), docs[9], docs[9], (9, pick(20))]
    items = [(i, pick(12)) for i in range(12)] + [(20, docs[7][1]), (21, None), (22, "..."), (23, "absent"), (1, "extra terms é1"), (None, docs[3][1])]
    return docs, items


def test_search_equals_brute_force(spark, monkeypatch):
    docs, items = search_rows(random.Random(5))
    items_frame = spark.createDataFrame(items, "item_id long, text string")
    want = search_by_force(docs, items)
    got = ranked_search.rank_documents(frame(spark, docs), items_frame)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    blocks = ranked_search.rank_documents(frame(spark, docs, 1), items_frame, block_chars=300)
    assert sorted(str(tuple(r)) for r in blocks.collect()) == want


def test_search_of_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b")]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.rank_documents(docs, items).count() == 1
    assert ranked_search.rank_documents(docs.limit(0), items).count() == 0
    assert ranked_search.rank_documents(docs, items.limit(0)).count() == 0


def random_tree(rng, n, vocabulary=300):
    vectors = []
    for _ in range(n):
        terms = np.unique(np.minimum(rng.exponential(40, rng.integers(1, 40)).astype(np.int64), vocabulary - 1))
        vectors.append((terms, rng.integers(1, 5, len(terms)).astype(np.int32)))
    m = rng.integers(80, 200, n).tolist()
    return vectors, m, ranked_search.build(list(range(n)), vectors, m)


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    vectors, m, tree = random_tree(rng, 3000)
    leaves = [(a, b) for a, b, leaf in zip(tree.first, tree.last, tree.leaf) if leaf]
    assert sorted(x for a, b in leaves for x in range(a, b)) == list(range(3000)) and max(b - a for a, b in leaves) <= ranked_search.LEAF
    weights = np.zeros(300, np.int64)
    weights[rng.integers(60, 300, 8)] = 5000
    exact = {i: int((weights[t] * ranked_search._value(f.astype(np.int64), np.int64(k))).sum()) for i, ((t, f), k) in enumerate(zip(vectors, m))}

    def below(node):
        if tree.leaf[node]:
            return [tree.ids[x] for x in range(tree.first[node], tree.last[node])]
        return [i for c in range(tree.first[node], tree.last[node]) for i in below(c)]

    for node in range(len(tree.leaf)):
        bound = ranked_search._sums(tree.node_at, tree.node_terms, tree.node_values, node, node + 1, weights)[0]
        assert bound >= max(exact[i] for i in below(node))
    heap = []
    opened = ranked_search.search(tree, weights, heap)
    want = sorted(((s, -i) for i, s in exact.items() if s > 0), reverse=True)[:20]
    assert sorted(heap, reverse=True) == want and opened < len(tree.leaf)


# --- prefix trie -----------------------------------------------------------------------------------


def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def rebuilt_by_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            r, t = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, hashlib.sha256(f"{len(r)}:{r}:{t}".encode()).digest()), (r, t)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def trie_by_force(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * (words_in(p[-1][1]) if p else 0)
    out = []
    for p, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(sequences[c]) == len(p))))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def conversations(rng, n=120):
    rows = []
    for c in range(n):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["", None, "hi", "one two", "a b c"])) for _ in range(rng.randrange(1, 6))]
        rows += [(c, rng.choice([None, i, 1]), *x) for i, x in enumerate(turns)]
    deep = [("user", f"turn {i}") for i in range(300)]
    for c in range(200, 212):  # long copies, some of them cut
        rows += [(c, i, *x) for i, x in enumerate(deep[:300 - c % 3])]
    rows += [(1040, 0, "user", "own"), (-27, 0, "user", "x"), (-40, 1, "user", "y"), (None, 0, "user", "z"), (5, 0, "user", "hi"), (5, 0, "user", "hi")]
    return rows + [(c, 0, "user", "the same") for c in range(300, 420)]


@pytest.mark.parametrize("shard,fan", [(250_000, 64), (60, 2), (20, 3)])
def test_trie_equals_brute_force(spark, shard, fan):
    """Shards of a few conversations, so that boundary nodes are merged over several rounds."""
    rows = conversations(random.Random(shard))
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, ids string, words long")
    sequences = prefix_trie.rebuild(prefix_trie.encode(table))
    got = prefix_trie.prefix_nodes(sequences, shard_turns=shard, least_turns=shard, fan=fan)
    assert sorted(str(tuple(r)) for r in got.collect()) == trie_by_force(rebuilt_by_force(rows))


def test_trie_of_turnless_and_of_no_conversations(spark):
    rows = [(21, 0, "user", "only turn"), (3, 0, "user", "a")]
    assert any(zlib.crc32(str(c).encode()) % 4 for c, *_ in rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.prefix_nodes(prefix_trie.rebuild(prefix_trie.encode(table))).collect()
    assert sorted(str(tuple(r)) for r in got) == trie_by_force(rebuilt_by_force(rows))
    assert prefix_trie.prefix_nodes(prefix_trie.rebuild(prefix_trie.encode(table.filter("false")))).count() == 0


def test_ternary_tree_is_balanced():
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.medians_first(1000):
        tree.insert([i], [1], 1, i, i)
    depth, level = 0, [tree.eq[0]]
    while level:
        depth, level = depth + 1, [n for x in level for n in (tree.lo[x], tree.hi[x]) if n >= 0]
    assert depth == 10 and sorted(prefix_trie.medians_first(7)) == list(range(7))
    order, parent, _ = tree.walk()
    assert len(order) == 1001 and set(parent[1:]) == {0}


def test_crc_fold_is_the_checksum_of_the_decimal_id(spark):
    row = spark.range(1).select((F.crc32(F.lit(123).cast("string").cast("binary")) % 4).alias("h")).first()
    assert row.h == zlib.crc32(b"123") % 4
