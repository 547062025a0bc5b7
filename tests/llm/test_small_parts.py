"""The parts that need no Spark, against brute force."""

import math
import pickle
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chronofold.llm import kept, language, mixing, near_dup, packing, range_coder, shingles, tokens, toxicity, vptree
from chronofold.llm.token_store import joined_crc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def true_shingles(text, width):
    words = [ascii_lower(w) for w in WORD.findall(text or "")]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_shingle_sets_are_as_those_of_the_words():
    rng = random.Random(1)
    bits = ["a", "B", "é", "ab", "É", " ", "\t", "\n", "\x0b", "\x1c", "  ", "c"]
    texts = [None, "", " \n", "One", "one", "a b c", "A  b\tc", "x " * 5000, *("".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(400))]
    for width in (4, 5):
        sets = shingles.shingle_sets([None if t is None else t.encode() for t in texts], width)
        true = [true_shingles(t, width) for t in texts]
        assert [len(s) for s in sets] == [len(t) for t in true]
        seen = {}
        for hashes, grams in zip(sets, true, strict=True):
            assert seen.setdefault(frozenset(grams), hashes.tolist()) == hashes.tolist()
        assert len({tuple(h) for h in seen.values()}) == len(seen)


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_looked_up_words_give_the_ids_of_the_whole_text(vocabulary):
    rng = random.Random(2)
    bits = ["a", "Word", " ", "  ", "\n", "\t", "é", "́", "'s", "don't", "Ünï", "12", "!?", "。", "漢字", " ", ".", ",", "Σ", "\x1c", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "😀", "z", "İ", "ﬁ", "#", "***"]
    texts = [None, "", *("".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(3000)), "long " * 5000]
    own = tokens.WordEncoder(vocabulary)
    library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    texts += ["hello <|endoftext|> world", "a<|startoftext|>", "<|endoftext|>"]
    whole = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(i, dtype="<u4").tolist() for i in own.encode(texts)] == whole


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_the_store_of_words_stays_small_and_gives_the_same_ids(vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 60)
    monkeypatch.setattr(tokens, "WORDS_NEW", 40)
    rng = random.Random(7)
    words = ["".join(rng.choices("abcXYZ'é,.1", k=rng.randint(1, 6))) for _ in range(2000)]
    texts = [" ".join([*rng.choices(words[:20], k=8), *words[k : k + 10]]) for k in range(0, 2000, 10)]
    own, library = tokens.WordEncoder(vocabulary), Tokenizer.from_file(public_tokenizers.path(vocabulary))
    for text in texts:
        [ids] = own.encode([text])
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(own.known) + len(own.new) < 60 + 40 + 80  # what one text adds
    assert words[0] in own.known or " " + words[0] in own.known


def test_a_worker_keeps_one_model_at_a_time():
    first = tokens.encoder("word_bpe_49k.json")
    assert tokens.encoder("word_bpe_49k.json") is first
    language._parser({"en": [97, 98, 97]})
    assert [key[0] for key in kept._KEPT] == ["parser"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "text": pa.array(["a b c d e"])})
    assert len(list(near_dup._sets(iter([batch]), 4))) == 1 and not kept._KEPT


def test_texts_of_plain_spaces_are_told_from_others():
    rng = random.Random(4)
    odd = re.compile(r"\s\s|^\s|\s\Z|[^\S \n]")
    for _ in range(3000):
        text = "".join(rng.choices(["a", "b", " ", "\n", "c d", "\t", "\x1c", "\x85", "\u2003", "é"], weights=[9, 9, 5, 3, 9, 1, 1, 1, 1, 2], k=rng.randint(1, 9)))
        assert tokens._plainly_spaced(text, text.split()) == (odd.search(text) is None)


def test_near_copies_that_are_no_links_stay_few_rows_however_many_pairs_they_make():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(1, 1 << 62, 400))
    full = [np.unique(np.append(x := base[rng.random(400) > p], rng.integers(1, 1 << 62, 400 - len(x)))) for p in rng.choice([0.04, 0.14, 0.16], 200)]
    rows = [{"value": 5, "low": 0, "high": 0, "chunk": 0, "main": False, "node": k, "component": k, "n_shingles": len(x), "sketch": x[:64], "lists": x[:0]} for k, x in enumerate(full)]
    found = near_dup._candidates(pd.DataFrame(rows), 80)
    pairs = {(min(a, b), max(a, b)) for a, its in zip(found["node"], found["partners"], strict=True) for b in its}
    likeness = {(a, b): len(np.intersect1d(full[a], full[b])) / len(np.union1d(full[a], full[b])) for a in range(200) for b in range(a)}
    links = {(b, a) for (a, b), x in likeness.items() if x >= 0.8}
    assert len(found) <= len(full) < 5000 < len(pairs) and links <= pairs and len(links) < len(pairs) / 2
    for some in (found, found.assign(partners=[its[:9] for its in found["partners"]])):
        its_links = links & {(min(a, b), max(a, b)) for a, its in zip(some["node"], some["partners"], strict=True) for b in its}
        kept = near_dup._links_of_group(some.assign(full=[full[k] for k in some["node"]]), 80)
        kept = set(zip(kept["a"].tolist(), kept["b"].tolist(), strict=True))
        assert kept <= its_links and len(kept) < len(full) and parts_of(kept) == parts_of(its_links)
    group = pd.DataFrame(rows).assign(component=[k // 2 for k in range(200)])
    forest = near_dup._forest_pairs(group, 80)
    assert 0 < len(forest) < 100 and all(a // 2 != b // 2 for a, b in zip(forest["a"], forest["b"], strict=True))


def parts_of(pairs):
    root = {x: x for pair in pairs for x in pair}
    for _ in root:
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root
    return root


def test_coded_blocks_come_back_and_damage_is_seen():
    rng = np.random.default_rng(3)
    blocks = [np.array([], dtype=np.uint32), np.array([7], dtype=np.uint32), np.array([2**32 - 1, 5, 2**31], dtype=np.uint32), np.full(8192, 9, dtype=np.uint32), np.tile(np.arange(5, dtype=np.uint32), 1600)]
    blocks += [rng.integers(0, rng.integers(1, 50257), rng.integers(1, 2000)).astype(np.uint32) for _ in range(40)]
    coded = range_coder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, range_coder.decode(coded), strict=True))
    assert len(coded[3]) < 150 and len(coded[4]) < 150
    assert np.array_equal(range_coder.decode([coded[7]])[0], blocks[7])  # alone, too
    broken = bytearray(coded[8])
    broken[len(broken) // 2] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode([bytes(broken)])


def test_crc_of_pieces():
    raw = bytes(range(200))
    cuts = [raw[:40], raw[40:44], raw[44:]]
    assert joined_crc([len(c) // 4 for c in cuts], [zlib.crc32(c) for c in cuts]) == zlib.crc32(raw)


def test_phrases_are_those_of_a_plain_parse():
    rng = random.Random(4)
    texts = {name: [ord(c) for c in "".join(rng.choices(letters, k=600))] for name, letters in (("x", "abc "), ("y", "bcd "))}
    parser = language.CrossParser(texts)

    def phrases(stretch, own):
        own, at, n = "".join(map(chr, own)), 0, 0
        while at < len(stretch):
            end = at + 1
            while end <= len(stretch) and stretch[at:end] in own:
                end += 1
            at, n = max(at + 1, end - 1), n + 1
        return n

    for size in (1, 5, 300, 5000):
        text = "".join(rng.choices("abcdz ", k=size)).strip() or "a"
        symbols = "".join(map(chr, language.plain_symbols(text)))
        true = [sum(phrases(symbols[i : i + language.STRETCH], texts[name]) for i in range(0, len(symbols), language.STRETCH)) for name in parser.languages]
        got = parser.entropies([text])[:, 0] * len(symbols) / parser.bits
        assert np.allclose(got, true)
    judged = parser.judge([None, "", "12 !", "abca"])
    assert judged["lang_pred"].tolist()[:3] == ["und"] * 3 and judged["score"].between(0, 1).all()


def test_neighbours_by_block_bounds_are_exact():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, rng.randint(0, 1), dict(Counter(rng.choices(words, k=rng.randint(1, 6))))) for i in range(900)]
    idf = {w: rng.uniform(0.5, 3) for w in words}
    index = toxicity.NearestExamples(rows, idf, 0.5)

    def vector(counts):
        weights = {w: (1 + math.log(c)) * idf[w] for w, c in counts.items()}
        return {w: x / math.sqrt(sum(y * y for y in weights.values())) for w, x in weights.items()}

    vectors = [vector(r[2]) for r in rows]
    for _ in range(50):
        counts = Counter(rng.choices(words, k=4))
        query = vector(counts)
        cosines = sorted(((sum(x * v.get(w, 0) for w, x in query.items()), i) for i, v in enumerate(vectors)), key=lambda c: (-c[0], c[1]))
        got = index.nearest(counts)
        assert np.allclose([c for c, _ in got], [c for c, _ in cosines[: toxicity.NEAREST] if c > 0])
    assert index.score(None)[0] == index.score("")[0] == 0.5


@pytest.mark.parametrize("common", [2, 20, 10**9])
def test_texts_searched_together_have_the_neighbours_of_each_alone(common, monkeypatch):
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "POSTINGS", 5000)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    often = [1 / (i + 1) for i in range(300)]
    rows = [(i // 2, rng.randint(0, 1), dict(Counter(rng.choices(words, often, k=rng.randint(1, 30))))) for i in range(700)]
    idf = {w: rng.uniform(0.5, 3) for w in words}
    index = pickle.loads(pickle.dumps(toxicity.NearestExamples(rows, idf, 0.5)))
    assert len(pickle.dumps(index)) < 60 * sum(len(r[2]) for r in rows)  # no matrix goes to the workers
    unit = [{w: (1 + math.log(c)) * idf[w] for w, c in r[2].items()} for r in sorted(rows, key=lambda r: (r[0], r[1], sorted(r[2].items())))]
    unit = [{w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()} for v in unit]
    counts = [Counter(rng.choices([*words, "new"], [*often, 0.1], k=rng.randint(0, 40))) for _ in range(150)] + [Counter(), Counter(["new"])]
    for got, asked in zip(index.nearest_of(counts), counts, strict=True):
        query = {w: (1 + math.log(c)) * idf[w] for w, c in asked.items() if w in idf}
        norm = math.sqrt(sum(x * x for x in query.values()))
        cosines = sorted(((sum(x / norm * v.get(w, 0) for w, x in query.items()), i) for i, v in enumerate(unit)), key=lambda c: (-round(c[0], 12), c[1])) if norm else []
        cosines = [c for c in cosines[: toxicity.NEAREST] if c[0] > 0]
        assert [i for _, i in got] == [i for _, i in cosines] and np.allclose([c for c, _ in got], [c for c, _ in cosines], rtol=0, atol=1e-12)


def test_tree_search_is_exact_at_factor_one():
    rng = np.random.default_rng(6)
    vectors = vptree._unit(np.concatenate([rng.normal(size=(700, 8)), np.repeat(rng.normal(size=(3, 8)), 40, axis=0)]))
    ids = np.arange(len(vectors)) // 2
    tree = vptree.VantagePointTree(vectors, ids, leaf=16)
    queries, own = vectors[::37], ids[::37]
    found, away = tree.search(queries, own, 5)
    for q, o, f, a in zip(queries, own, found, away, strict=True):
        d = np.where(ids == o, np.inf, vptree._distance(vectors @ q))
        assert np.allclose(np.sort(d)[:5], a, atol=1e-6) and (ids[f] != o).all()


def test_best_fit_and_its_bound():
    rng = np.random.default_rng(7)
    for capacity in (10, 97):
        for _ in range(30):
            lengths = np.sort(rng.integers(1, capacity + 1, rng.integers(1, 60)))[::-1]
            bins = packing.best_fit(lengths, capacity)
            assert np.bincount(bins, weights=lengths).max() <= capacity
            assert math.ceil(lengths.sum() / capacity) <= packing.lower_bound(lengths, capacity) <= bins.max() + 1
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3  # the plain sum says 2
    assert packing.lower_bound(np.array([], dtype=int), 10) == 0


def test_shards_meet_the_totals():
    counts = np.array([1000, 0, 7, 12345])
    shards = -(-int(counts.sum()) // 512)
    rows = [mixing.shard_counts(k, shards, counts, slots=512) for k in range(shards)]
    assert sum(n for n, _ in rows).tolist() == counts.tolist()
    assert np.array_equal(rows[5][1], sum(n for n, _ in rows[:5])) and all(n.sum() == 512 for n, _ in rows[:-1])


def test_estimate_on_the_union_is_exact_for_small_sets_and_near_for_large():
    assert near_dup._union_estimate(np.arange(10), np.arange(5, 15)) == 5 / 15
    rng = np.random.default_rng(8)
    values = np.unique(rng.integers(0, 2**63, 9000).astype(np.uint64))
    estimates = []
    for _ in range(50):
        rng.shuffle(values)
        estimates.append(near_dup._union_estimate(np.sort(values[:4500]), np.sort(values[500:5000])))
    assert abs(np.mean(estimates) - 0.8) < 0.03 and min(estimates) > near_dup.LEAST


def test_candidates_hold_the_smallest_ids_of_many_equal_vectors():
    rng = np.random.default_rng(9)
    for size, width in ((40, 16), (300, 64)):
        originals = np.repeat(rng.normal(size=(1200 // size, width)), size, axis=0)[rng.permutation(1200)]
        tree, ids = vptree.VantagePointTree(vptree._unit(originals), np.arange(1200)), np.arange(1200)
        at, rows = tree.candidates(vptree._unit(originals), ids, 5)
        score = vptree._scores(originals, originals, at, rows)
        for q in range(1200):
            mine = rows[at == q]
            true = [i for i in range(1200) if i != q and np.array_equal(originals[i], originals[q])][:5]
            assert sorted(mine, key=dict(zip(mine, zip(-score[at == q], mine, strict=True), strict=True)).get)[:5] == true


def test_large_runs_of_shards_are_drawn_too():
    counts = np.array([2 * 10**9, 0, 500, 3 * 10**9, 7])
    slots = 25 * 10**8
    drawn = np.array([mixing._half(counts, slots, (1, 0, k)) for k in range(300)])
    assert (drawn.sum(axis=1) == slots).all() and (drawn >= 0).all() and (drawn <= counts).all()
    share = slots / counts.sum()
    true = np.sqrt(counts * share * (1 - share) * (1 - counts / counts.sum()))
    assert np.allclose(drawn.mean(axis=0), counts * share, atol=5 * true.max() / 17) and abs(drawn[:, 2].mean() - 250) < 4
    assert np.allclose(drawn.std(axis=0), true, rtol=0.2)


def test_long_texts_are_hashed_in_pieces_of_bounded_memory(monkeypatch):
    rng = np.random.default_rng(5)
    text = " ".join(f"w{k}" for k in rng.integers(0, 5000, 400_000)).encode() + b"  \n" + b"x" * 9000
    whole = shingles.shingle_sets([text, b"", None, b"a b"], 4)
    monkeypatch.setattr(shingles, "PIECE", 1000)
    for one, other in zip(whole, shingles.shingle_sets([text, b"", None, b"a b"], 4), strict=True):
        assert np.array_equal(one, other)
    tracemalloc.start()
    shingles.words_of(np.frombuffer(text, dtype=np.uint8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * len(text)


def test_sets_come_in_slices_of_bounded_bytes(monkeypatch):
    monkeypatch.setattr(near_dup, "_BYTES", 100)
    texts = [None, "", "ein zwei drei", "x " * 400, *["some words of a text"] * 30, "ä ö"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    got = list(near_dup._sets(iter([batch]), 4))
    assert len(got) > 5 and [i for ids, _ in got for i in ids.to_pylist()] == list(range(len(texts)))
    want = shingles.shingle_sets([None if t is None else t.encode() for t in texts], 4)
    assert all(np.array_equal(x, y) for x, y in zip(want, [s for _, sets in got for s in sets], strict=True))
    assert not list(near_dup._sets(iter([batch.slice(0, 0)]), 4))


def test_shared_values_are_counted_in_blocks(monkeypatch):
    monkeypatch.setattr(near_dup, "_VALUES", 3)
    rng = np.random.default_rng(6)
    one, other = ([np.unique(rng.integers(-20, 20, n)) for n in sizes] for sizes in ((0, 5, 9), (7, 0, 12, 30)))
    got = near_dup._held_by_both(one, other)
    assert got.tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in other] for x in one]


def test_trees_over_like_distances_stay_shallow():
    for originals in (np.eye(1400), np.ones((3000, 4)), np.repeat(np.eye(3), 700, axis=0)):
        tree = vptree.VantagePointTree(vptree._unit(originals), np.arange(len(originals)), leaf=8)
        assert len(tree.nodes) < len(originals)
        queries = np.arange(0, len(originals), 199)
        at, rows = tree.candidates(vptree._unit(originals[queries]), queries, 5)
        score = vptree._scores(originals[queries], originals, at, rows)
        for k, q in enumerate(queries):
            cosine = vptree._unit(originals) @ vptree._unit(originals[[q]])[0]
            cosine[q] = -2
            want = np.lexsort((np.arange(len(cosine)), -cosine.round(12)))[:5]
            mine = at == k
            assert rows[mine][np.lexsort((rows[mine], -score[mine].round(12)))[:5]].tolist() == want.tolist()


def test_cosines_of_tiny_and_huge_vectors():
    ones, mixed = np.ones(4), np.array([3.0, -1.0, 0.0, 2.0])
    for low, high in ((1e-200, 1e200), (5e-324, 1e308), (1e-160, 1e155)):
        vectors = np.array([ones, ones * low, ones * high, mixed * 1e-150, mixed * 1e150])
        at, rows = (x.ravel() for x in np.indices((5, 5)))
        unit = np.array([ones, ones, ones, mixed, mixed])
        assert np.allclose(vptree._scores(vectors, vectors, at, rows), vptree._scores(unit, unit, at, rows), rtol=1e-12)


def test_a_smaller_factor_leaves_out_more():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 12))
    vectors = vptree._unit(np.repeat(centres, 50, axis=0) + 0.2 * rng.normal(size=(2000, 12)))
    tree, ids = vptree.VantagePointTree(vectors, np.arange(2000), leaf=16), np.arange(2000)
    exact, found = tree.search(vectors[::20], ids[::20], 5)[0], {}
    for factor in (1.0, 0.5, 0.2):
        rows = tree.search(vectors[::20], ids[::20], 5, factor)[0]
        found[factor] = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(exact.tolist(), rows.tolist(), strict=True)])
    assert found[1.0] == 1 and found[0.5] >= 0.9 and found[0.2] <= found[0.5]
