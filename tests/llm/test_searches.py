"""The threshold algorithm, the prefix trie and the best position algorithm against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronofold.llm import best_position, prefix_trie, threshold
from chronofold.llm.best_position import ImpactLists, ranked
from chronofold.llm.prefix_trie import prefix_nodes
from chronofold.llm.threshold import SortedLists, top_products

VECTORS = "vec_id long, embedding array<float>, shard string, floor int"
DOCS = "doc_id long, text string, words string, terms int"
ITEMS = "item_id long, text string, hits int"
TURNS = "conv_id long, turn long, role string, text string, depth string, a string"


def table(spark, rows, schema):
    """Rows given without the last two columns, which only clash in name."""
    width = len(schema.split(", "))
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)


# ---- exact top-k by inner product

def products_by_hand(rows, every=50, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in sorted((i, tuple(v)) for i, v in good if i % every == 0):
        queries.setdefault(i, v)
    out = []
    for q, v in queries.items():
        found = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -2**63), 2**63 - 1), i) for i, w in good if i != q and len(w) == len(v))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def test_products_with_nulls_ties_copies_and_lengths(spark, shared):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6).round(1)]) for i in range(240)]
    rows += [(250, [0.0] * 6), (300, []), (301, []), (350, [1.0, -1.0]), (351, [0.5, 0.5]), (400, None), (None, [1.0] * 6)]
    rows += [(450, [float("nan")] * 6), (500, [None] * 6), (501, [float("inf")] + [0.0] * 5), rows[7], rows[50], (50, [0.1] * 6)]
    rows += [(600 + i % 2, [0.4] * 6) for i in range(20)]
    want = products_by_hand(rows)
    for shard_rows in (10_000, 30):
        found = top_products(table(spark, rows, VECTORS), shard_rows=shard_rows)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, found.collect())) == want


def test_products_of_huge_components_and_of_nothing(spark, shared):
    rows = [(0, [3e38, -1.0]), (50, [1e30, 2.0]), (1, [3e38, 1.0]), (2, [3e38, 2.0]), (3, [-3e38, 0.0]), (4, [1.0, 1.0])]
    assert sorted(map(tuple, top_products(table(spark, rows, VECTORS)).collect())) == products_by_hand(rows)
    assert top_products(table(spark, [], VECTORS)).count() == 0
    assert top_products(table(spark, [(0, [1.0])], VECTORS)).count() == 0


def test_bound_stops_early_and_is_exact():
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * rng.exponential(1, (5000, 4)) ** 3)
    ids = rng.permutation(5000)
    lists = SortedLists(vectors, ids)
    for q in range(20):
        query = vectors[q] * rng.choice([1, -1, 0], 4)
        scores = vectors @ query
        want = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != ids[q])[:5]
        assert lists.top(query, int(ids[q]), 5) == [(-s, i) for s, i in want]
        kept = [x for x in lists.top(query, int(ids[q]), 5, floor=-want[2][0])]
        assert kept[:3] == [(-s, i) for s, i in want[:3]]
    assert lists.accesses < 0.5 * 40 * 5000


# ---- ranked lexical search

def ranks_by_hand(docs, items, k=50):
    term = re.compile(best_position.TERM)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bags = [(i, Counter(term.findall((t or "").translate(lower)))) for i, t in docs]
    n_docs, n_words = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(term.findall((t or "").translate(lower)))
    out = []
    for item, terms in asked.items():
        found = []
        for i, b in bags:
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * b[t]) // (1000 * b[t] + 20 * (50 + (50 * b.total() * n_docs) // n_words))) for t in terms if b[t])
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def some_documents():
    rng = np.random.default_rng(11)
    words = [f"w{int(x)}" for x in rng.zipf(1.3, 9000) % 400]
    docs = [(i, " ".join(words[30 * i : 30 * i + int(n)])) for i, n in enumerate(rng.integers(1, 30, 300))]
    docs += [(400, None), (401, ""), (402, "... !"), (None, "w1 w2 w3"), (403, "É É é W7 w7-w9_w9 3.5"), (404, "w1 " * 60_000), docs[3], docs[3], (3, "w2 w5")]
    docs += [(500 + i, "w3 w4 w398") for i in range(120)] + [(700, "w398 w7")] * 60
    items = [(1, "w1 w2, w3 W4"), (2, "é 3 5 W398"), (3, ""), (4, None), (5, "nowhere"), (None, "w1"), (6, "w5 w5 w9"), (6, "w6 w398")]
    return docs, items


def test_ranks_with_nulls_ties_copies_and_long_texts(spark, shared):
    docs, items = some_documents()
    want = ranks_by_hand(docs, items)
    for shard_docs in (10_000, 40):
        found = ranked(table(spark, docs, DOCS), table(spark, items, ITEMS), shard_docs=shard_docs)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, found.collect())) == want


def test_ranks_of_nothing(spark, shared):
    docs, items = some_documents()
    assert ranked(table(spark, [], DOCS), table(spark, items, ITEMS)).count() == 0
    assert ranked(table(spark, docs, DOCS), table(spark, [], ITEMS)).count() == 0
    assert ranked(table(spark, [(1, None), (2, "?")], DOCS), table(spark, items, ITEMS)).count() == 0


def test_best_positions_stop_early_and_are_exact():
    rng = np.random.default_rng(2)
    owner = np.repeat(np.arange(4000), 8)
    terms = rng.integers(0, 12, len(owner))
    pairs, counts = np.unique(np.stack([owner, terms]), axis=1, return_counts=True)
    ids = rng.permutation(4000)
    lists = ImpactLists(ids, 50 + rng.integers(0, 3, 4000), pairs[0], pairs[1], counts)
    impact = defaultdict(dict)
    for row, term, g in zip(np.repeat(np.arange(4000), np.diff(lists.doc_from)), lists.terms[lists.doc_term], lists.doc_impact):
        impact[int(row)][int(term)] = int(g)
    for _ in range(10):
        some, weights = rng.choice(14, 3, replace=False), rng.integers(1, 9000, 3)
        want = sorted((-sum(int(w) * g.get(int(t), 0) for t, w in zip(some, weights)), row) for row, g in impact.items())
        rows, scores = lists.best(some, weights, 10)
        assert list(zip(-scores, rows)) == [x for x in want if x[0] < 0][:10]
        assert (lists.slots == -1).all()
    assert lists.accesses < 0.7 * 10 * 4000


# ---- prefix trie

def nodes_by_hand(rows):
    order, turns = defaultdict(list), {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            order[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in order.items()}
    built = {}
    for c, own in turns.items():
        h, first = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        built[c] = tuple(turns.get(first, [])[:h] + own[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, w in sorted(built.items()):
        ends[w].append(str(c))
        for d in range(len(w) + 1):
            members[w[:d]].append(c)
            if d:
                children[w[: d - 1]].add(w[:d])
    sums = defaultdict(lambda: [0, 0])
    for w, m in members.items():
        for d in range(len(w) + 1):
            sums[w[:d]][0] += not children[w]
            sums[w[:d]][1] += (len(m) - 1) * len(w[-1][1].encode()) if w else 0
    return sorted((m[0], len(w), members[w[:-1]][0] if w else None, len(m), len(children[w]), *sums[w],
                   hashlib.sha256(",".join(ends[w]).encode()).hexdigest()) for w, m in members.items())


def in_order(df):
    return sorted(map(tuple, df.collect()))


def some_conversations():
    rng = np.random.default_rng(4)
    rows = []
    for c in [*range(60), *range(-7, 0), 10**15, 10**15 + 1]:
        rows += [(c, int(t), ["user", None, "x"][t % 3], ["", "é" * 3, None, "abc"][int(rng.integers(4)) if t > 3 else t]) for t in range(int(rng.integers(0, 9)))]
    rows += [(70, t, "user", f"deep {t}") for t in range(75)] + [(71, t, "user", f"deep {t}") for t in range(60)]
    rows += [(c, t, "user", f"deep {t}") for c in (80, 85, 90) for t in range(75)]
    rows += [(100, None, "u", "a"), (100, None, "u", "b"), (100, 3, "u", "c"), (100, 3, "u", "a"), (100, 3, "u", "a"), (None, 1, "u", "x"), (101, -5000, "u", "far"), (101, 9000, "v", "off")]
    return rows + [(c, 0, None, None) for c in range(200, 230)] + rows[:3]


@pytest.mark.parametrize("band, stretch", [(16, 1024), (3, 2)])
def test_nodes_with_nulls_ties_copies_and_depth(spark, shared, monkeypatch, band, stretch):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 2)
    rows = some_conversations()
    found = prefix_nodes(table(spark, rows, TURNS))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(nodes_by_hand(rows), key=key)


def test_nodes_of_nothing_and_texts_of_nodes(spark, shared):
    assert prefix_nodes(table(spark, [], TURNS)).count() == 0
    lone = table(spark, [(0, 1, "u", "b"), (0, 0, "u", "a")], TURNS)
    lengths, turns = prefix_trie.rebuilt(prefix_trie.numbered_turns(lone))
    nodes, _ = prefix_trie.trie(lengths, turns)
    assert {(r.depth, r.role, r.text, r.n_leaves) for r in prefix_trie.last_turns(lone, nodes).collect()} == {(1, "u", "a", 1), (2, "u", "b", 1)}
