"""The operators on small tables: odd rows of every kind, and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chronofold.llm import fingerprint, language, mixing, near_dup, packing, pii, token_store, toxicity, url_filter, vptree

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, block string, size int, number int"
VOCABULARY = [f"word{i}" for i in range(60)]


def rows(seed=1, n=40):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "12 !?", "one", "a@b.com +1 (202) 555-0143, 4111 1111 1111 1111, 1.2.3.4", "x" * 20000, "ab " * 20000]
    texts += [" ".join(rng.choices(VOCABULARY, k=rng.randint(1, 60))) for _ in range(n)]
    texts += [texts[-1], texts[-1] + " more"]
    ids = rng.sample(range(-50, 10**6), len(texts))
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), len(t or ""), "x", 7, k) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    out[20] = (*out[20][:2], None, None, None, None, None, None)
    return out


def library(vocabulary):
    """The tokenizer as the library loads it."""
    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


@pytest.fixture(scope="module")
def docs(shared):
    return shared.createDataFrame(rows(), DOCS).cache()


@pytest.fixture(scope="module")
def none(shared):
    return shared.createDataFrame([], DOCS)


def test_store_keeps_every_id(docs, none):
    got = {r.doc_id: r for r in token_store.stored_documents(docs).collect()}
    start = 0
    for doc_id, text in sorted((r[0], r[1]) for r in rows()):
        ids = [*library(token_store.VOCABULARY).encode(text or "", add_special_tokens=False).ids, token_store.END]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_store.stored_documents(none).count() == 0


def test_language_of_odd_rows(docs, none):
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    assert len(got) == len(rows())
    for doc_id, text, *_ in rows():
        letters = any(map(str.isalpha, text or ""))
        assert (got[doc_id].lang_pred != "und") == letters and 0 <= got[doc_id].score <= 1
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
    assert language.identified(none).count() == 0
    kept = language.in_a_known_language(docs)
    assert kept.columns == docs.columns and kept.count() == sum(any(map(str.isalpha, r[1] or "")) for r in rows())
    unlabelled = docs.withColumn("lang", docs["text"].cast("string").substr(1, 0)).where("false")
    assert language.in_a_known_language(unlabelled).count() == 0


def test_language_on_held_out_rows(shared):
    got = language.identified(shared.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    lang = {r.doc_id: r.lang for r in shared.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r.lang_pred == lang[r.doc_id] for r in got.where("held_out").collect()]
    assert np.mean(held) > 0.96


def test_toxicity(shared, docs, none):
    labels = shared.createDataFrame([(r[0], k % 2, k % 3) for k, r in enumerate(rows())] + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.scores(docs, labels).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert toxicity.scores(none, labels).count() == 0
    assert toxicity.scores(docs, labels.where("false")).where("score = 0").count() == len(rows())


def test_toxic_words_are_found_on_held_out_rows(shared):
    rng = random.Random(3)
    bad = ["scum", "vermin"]
    texts = [(k, " ".join(rng.choices(VOCABULARY, k=30) + ([rng.choice(bad)] * 2 if k % 7 == 0 else []))) for k in range(600)]
    labels = shared.createDataFrame([(k, int(k % 7 == 0)) for k, _ in texts], "doc_id long, toxic int")
    got = toxicity.scores(shared.createDataFrame(texts, "doc_id long, text string"), labels).where("held_out").collect()
    assert all(r.predicted == int(r.doc_id % 7 == 0) for r in got)


def test_toxicity_equals_brute_force_cosines_over_all_terms(shared):
    """Two topics, half of the labels toxic: scores are those of plain cosines over every term, and a text like clean examples is clean."""
    rng = random.Random(8)
    topics = [[f"{t}{i:02d}word" for i in range(60)] for t in "ab"]
    texts = [(k, " ".join(rng.choices(topics[k % 2], k=25))) for k in range(300)] + [(8, topics[0][0]), (8, topics[0][0]), (900, "unheard"), (901, "")]
    texts += [(902, "  ".join(texts[4][1].upper().split()))]
    labels = [(k, k % 2) for k in range(300)] + [(6, None), (None, 1)]
    docs = shared.createDataFrame(texts, "doc_id long, text string")
    got = toxicity.scores(docs, shared.createDataFrame(labels, "doc_id long, toxic int")).collect()
    counted = [toxicity.terms(t) for _, t in texts]
    n, df = sum(bool(c) for c in counted), Counter(w for c in counted for w in c)
    known = dict(label for label in labels if None not in label)
    found = sorted({(i, t) for i, t in texts if i in known and zlib.crc32(str(i).encode()) % 4 != 2})
    rows = [(known[i], toxicity.terms(t)) for i, t in found]
    held, bad = Counter(w for _, c in rows for w in c), Counter(w for y, c in rows if y for w in c)
    weight = {w: math.log(1 + n / df[w]) * math.log2(2 + bad[w] / max(1, held[w] - bad[w])) for w in held}

    def vector(counts):
        v = {w: (1 + math.log(c)) * weight[w] for w, c in counts.items() if w in weight}
        return {w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()}

    vectors, share = [(y, vector(c)) for y, c in rows], sum(y for y, _ in rows) / len(rows)
    true = []
    for (i, _), counts in zip(texts, counted, strict=True):
        query = vector(counts)
        near = sorted(((sum(x * v.get(w, 0) for w, x in query.items()), y) for y, v in vectors), key=lambda c: -c[0])[: toxicity.NEAREST]
        near = [c for c in near if c[0] > 0]
        true.append((i, (sum(c * y for c, y in near) + toxicity.SHRINK * share) / (sum(c for c, _ in near) + toxicity.SHRINK)))
    assert len(found) > 200 and len(got) == len(texts)
    assert np.allclose([s for _, s in sorted(true)], [r.score for r in sorted(got, key=lambda r: (r.doc_id, r.score))], atol=1e-9)
    by_id = {r.doc_id: r for r in got}
    assert all(r.predicted == r.doc_id % 2 for r in got if r.held_out and r.doc_id < 300)
    assert by_id[902].predicted == 0 and by_id[900].score == by_id[901].score == share


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_personal_data(shared, docs, none):
    rng = random.Random(2)
    bits = ["a@b.com", "_x@y.org", "1.2.3.4", "4111 1111 1111 1111", "+1 (202) 555-0143", "é", "ß😀", " ", ".", "@", "-", "5", "12", "+", "GB82 WEST 1234 5698 7654 32", "256.1.1.1", "007.1.1.1", "iban "]
    texts = [None, "", "x" * 50000, "a@b" + ".c" * 5000, "1." * 5000, "4111-1111-1111-1111 " * 600, *("".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(400))]
    got = {r.doc_id: r for r in pii.pii_report(shared.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, text in enumerate(texts):
        true = base_spans(text)
        assert got[k].base_sha256 == hashlib.sha256(true.encode()).hexdigest()
        assert ",".join(s for s in got[k].spans.split(",") if not s.startswith("iban")) == true
    assert any("iban" in r.spans for r in got.values())
    masked = pii.redacted(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count() and pii.redacted(none).count() == 0
    assert masked.where("text = '<EMAIL> <PHONE>, <CARD>, <IP>'").count() == 1
    assert pii.pii_report(none).count() == 0


def test_fingerprints(docs, none):
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    ordered = sorted((r[0], r[1] or "") for r in rows())
    near = []
    for k, (doc_id, text) in enumerate(ordered):
        following, quarter = ordered[(k + 1) % len(ordered)][1], len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        one, other = Counter(WORD.findall(text)), Counter(WORD.findall(edited))
        whole = sum((one | other).values())
        near.append(r.near_edited - (sum((one & other).values()) / whole if whole else 1.0))
        assert (r.fingerprint == "") == (not one)
    assert len(got) == len(ordered) and abs(np.mean(near)) < 0.06
    by_text = defaultdict(set)
    for doc_id, text in ordered:
        by_text[text].add(got[doc_id].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert fingerprint.fingerprints(none).count() == 0
    one = fingerprint.fingerprints(docs.where("text = 'one'")).first()
    assert one.near_edited == one.near_next == 1.0


def test_nearest_vectors(shared, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD", 70)
    monkeypatch.setattr(vptree, "QUERIES", 3)
    rng = np.random.default_rng(4)
    vectors = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(300)]
    vectors += [(k + 300, v) for k, v in vectors[:20]]  # ties
    odd = [(1000, None), (1050, []), (1100, [0.0] * 6), (1150, [float("nan")] + [1.0] * 5), (1200, [None] + [1.0] * 5), (1250, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    table = shared.createDataFrame([(*v, 1) for v in vectors + odd], "vec_id long, embedding array<double>, label int")
    got = defaultdict(list)
    for r in vptree.nearest(table).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    matrix = np.array([v for _, v in vectors])
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    assert sorted(got) == [k for k, _ in vectors if k % 50 == 0]
    for query, found in got.items():
        cosine = unit @ unit[query]
        cosine[query] = -2
        true = sorted(range(len(vectors)), key=lambda i: (-round(cosine[i], 12), i))[:5]
        assert [v for _, v, _ in sorted(found)] == true and [r for r, *_ in sorted(found)] == [1, 2, 3, 4, 5]
    assert vptree.nearest(table.where("false")).count() == 0


def components(texts, width, similar):
    sets = {}
    for doc_id, text in texts:
        words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text or "")]
        sets[doc_id] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()
    root = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if a < b and root[a] != root[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {i: (len(sets[i]), root[i]) for i in ids}


def test_near_duplicates(shared, docs, none):
    rng = random.Random(5)
    base = rng.choices(VOCABULARY, k=120)
    texts = [(r[0], r[1]) for r in rows()]
    for k in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
        texts.append((2_000_000 + k, " ".join(copy)))
    texts += [(3_000_000 + k, " ".join(rng.choices(VOCABULARY[:5], k=rng.randint(3, 8)))) for k in range(60)]
    table = shared.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in near_dup.near_duplicates(table).collect()}
    for doc_id, (n, root) in components(texts, 4, 80).items():
        assert (got[doc_id].n_shingles, got[doc_id].component_id, got[doc_id].kept) == (n, root, root == doc_id)
    assert near_dup.near_duplicates(none).count() == 0
    kept = near_dup.without_near_copies(docs, 5)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, root) in components([(r[0], r[1]) for r in rows()], 5, 80).items() if i == root)


def test_packing(docs, none, monkeypatch):
    monkeypatch.setattr(packing, "PART", 10)
    got = packing.packed_documents(docs, 256).collect()
    ids = {r[0]: [*library(packing.VOCABULARY).encode(r[1] or "", add_special_tokens=False).ids, packing.END] for r in rows()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, its in ids.items():
        cut = [its[i : i + 256] for i in range(0, len(its), 256)]
        assert sorted(pieces[doc_id]) == [(k, 256 * k, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cut)]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.05 * -(-sum(map(len, ids.values())) // 256) + 2
    whole = packing.sequences(docs, 256).agg({"n_tokens": "sum"}).first()[0]
    assert whole == sum(map(len, ids.values())) and packing.packed_documents(none).count() == 0


def test_rules_and_trees_judge_urls(shared):
    urls = [("HTTP://Ex.COM/a?b#c", "ex.com", "/a", "com/"), (None, "", "", None), ("x", "", "", None), ("http://www.example.com/en/1?q=http://a.b/c", "www.example.com", "/en/1", "www.example.com/en/"),
            ("a://b://c/d", "b:", "//c/d", None), ("http://notcom/x", "notcom", "/x", None), ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/"),
            ("http://x.net/es/1", "x.net", "/es/1", "net/es/"), ("http://com", "com", "", None), ("", "", "", None), ("http://É.com/" + "y" * 20000, "É.com", "/" + "y" * 20000, "com/")]
    table = shared.createDataFrame([(k, u[0], "h", "clash") for k, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_filter.judged(table).collect()}
    for k, (_, host, path, rule) in enumerate(urls):
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule) and got[k].verdict in ("allow", "block")
    assert [got[k].verdict for k in (0, 3, 6, 7)] == ["allow", "allow", "block", "block"]
    assert url_filter.judged(table.where("false")).count() == 0
    assert url_filter.judged(table.where("page_id in (0, 1)")).where("verdict = 'allow'").count() == 2


def water(sizes, weights):
    capped = set()
    while True:
        free = [s for s in sizes if s not in capped]
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return share | {s: 3 * sizes[s] for s in capped}
        capped |= over


def test_mixing(shared, docs, none):
    rng = random.Random(6)
    texts = [(r[0], r[1], r[3]) for r in rows()] + [(5_000_000 + k, " ".join(rng.choices(VOCABULARY, k=rng.randint(1, 400))), rng.choice(["big", "big", "big", "tiny", "é"])) for k in range(80)] + [(6_000_000, "a b", "z")]
    table = shared.createDataFrame(texts, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.taken_words(table).collect()}
    sizes = Counter()
    for doc_id, text, source in texts:
        assert got[doc_id].size == len(WORD.findall(text or ""))
        sizes[source] += got[doc_id].size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = water(dict(sizes), {s: k % 3 + 1 for k, s in enumerate(names)})
    taken = Counter()
    for doc_id, _, source in texts:
        r = got[doc_id]
        assert r.source_size == sizes[source] and np.isclose(r.target, target[source]) and r.taken <= 3 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = {r.doc_id: r.taken for r in mixing.taken_words(table.repartition(3)).collect()}
    assert again == {i: r.taken for i, r in got.items()}
    mixed = mixing.mixed_documents(table)
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == Counter({i: r.taken for i, r in got.items() if r.taken})
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.taken_words(none).count() == mixing.mixed_documents(none).count() == 0


def test_a_list_is_dealt_in_small_groups_where_all_components_meet_once(shared, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", 16)
    for largest in (1, 100):
        component = {k: 0 if k < largest else k for k in range(300)}
        members = shared.createDataFrame([(7, k, c) for k, c in component.items()], "value long, node long, component long")
        groups = defaultdict(list)
        for r in near_dup._dealt(members).collect():
            groups[r.low, r.high].append(r)
        assert max(map(len, groups.values())) <= 5 * near_dup.CHUNK
        met = Counter()
        for (low, high), held in groups.items():
            one, other = ([r.node for r in held if not r.main], [r.node for r in held if r.main]) if high < 0 else ([r.node for r in held if r.chunk == low], [r.node for r in held if r.chunk == high])
            met.update({(min(a, b), max(a, b)) for a in one for b in other if component[a] != component[b]})
        assert set(met.values()) == {1} and len(met) == sum(component[a] != component[b] for a in component for b in range(a))


def test_rows_of_null_doc_id_all_stay(shared):
    texts = [(1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "g h i j k l"), (None, None), (3, "m"), (3, "m")]
    kept = near_dup.without_near_copies(shared.createDataFrame(texts, "doc_id long, text string").coalesce(1))
    assert Counter(map(tuple, kept.collect())) == Counter([texts[0], *texts[2:6]])


def test_bins_that_stay_loose_meet_in_small_groups(shared, monkeypatch):
    monkeypatch.setattr(packing, "PART", 32)
    repacked = packing._repacked

    def watched(group, capacity, part):
        assert len(group) <= 100
        return repacked(group, capacity, part)

    monkeypatch.setattr(packing, "_repacked", watched)
    schema = "doc_id long, copy int, piece int, start long, length long, ids_crc32 long"
    for lengths in ([60] * 800, [60, 41, 30, 7] * 200):
        table = shared.createDataFrame([(k, 0, 0, 0, n, k) for k, n in enumerate(lengths)], schema)
        got = packing.pack(table, 100).collect()
        fill = Counter()
        for r in got:
            fill[r.sequence_id] += r.length
        assert sorted(r.doc_id for r in got) == list(range(800)) and max(fill.values()) <= 100
        assert len(fill) <= 1.03 * (packing.best_fit(np.sort(lengths)[::-1], 100).max() + 1)  # all in one group


def test_fingerprints_tell_near_copies_from_related_texts(shared):
    rng = random.Random(11)
    texts = []
    for k in range(60):
        words = [f"{k}w{i}" for i in range(90)]
        texts += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:80] + [f"{k}x{i}" for i in range(10)]))]  # likeness 0.8
        rng.shuffle(words)
    got = [r.near_next for r in fingerprint.fingerprints(shared.createDataFrame(texts, "doc_id long, text string")).where("doc_id % 2 = 0").collect()]
    assert abs(np.mean(got) - 0.8) < 0.02 and np.std(got) < 0.07 and max(got) < 1


def test_rows_that_repeat_a_doc_id_are_packed_and_stored_once_each(shared, monkeypatch):
    texts = [(1, "one two <|endoftext|> three"), (1, "one two <|endoftext|> three"), (None, "a b"), (None, "a b"), (2, None), (1, "other")]
    frame = shared.createDataFrame(texts, "doc_id long, text string").repartition(6)
    ids = {t: [*library(packing.VOCABULARY).encode(t or "", add_special_tokens=False).ids, packing.END] for _, t in texts}
    made = packing.sequences(frame, 8).collect()
    assert sum(r.n_tokens for r in made) == sum(len(r.ids) // 4 for r in made) == sum(len(ids[t]) for _, t in texts)
    stored = token_store.stored_documents(frame.where("doc_id is not null")).collect()
    lengths = [len(library(token_store.VOCABULARY).encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts if i]
    assert sorted(r.n_tokens for r in stored) == sorted(lengths)


def test_a_table_with_a_column_of_the_operators_own_name(shared):
    frame = shared.createDataFrame([(1, "a b c d e f", 1), (2, "a b c d e f", 2), (3, "x", 3)], "doc_id long, text string, __kept int")
    left = near_dup.without_near_copies(frame, 5)
    assert left.columns == frame.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_fingerprints_shuffle_the_texts_once(shared, monkeypatch):
    written = []

    def save(df):
        df.collect()
        written.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return df

    monkeypatch.setattr(fingerprint, "saved", save)
    fingerprint.fingerprints(shared.createDataFrame([(k, f"a text of {k} words") for k in range(300)], "doc_id long, text string")).collect()
    dealt = [line for line in written[0].splitlines() if re.search(r"Exchange hashpartitioning\(block#\d+L, \d+\)", line) and "Reused" not in line]
    assert len(dealt) == 1


def test_a_group_of_unlinked_relatives_is_dealt_by_its_rarest_full_values(shared, monkeypatch):
    base = [f"w{k}" for k in range(150)]
    rng, texts = random.Random(3), []
    for k in range(600):  # 8 words replaced change 32 of 147 shingles: linked with the base by some, seldom with one another
        own = base[:]
        for at in rng.sample(range(150), 8):
            own[at] = f"x{k}_{at}"
        texts.append((k + 1, " ".join(own)))
    dealt = []
    whole = near_dup._dealt

    def counted(members):
        dealt.append((members.select("value").distinct().count(), whole(members).count()))
        return whole(members)

    monkeypatch.setattr(near_dup, "_dealt", counted)
    docs = shared.createDataFrame([(0, " ".join(base)), *texts], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    sets = {i: {tuple(t.split()[k : k + 4]) for k in range(147)} for i, t in [(0, " ".join(base)), *texts]}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in range(a + 1, 601):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {i: find(i) for i in sets}
    assert len(set(got.values())) > 100
    assert all(rows < 12_000 for _, rows in dealt), dealt


def test_draws_made_together_are_those_made_one_by_one(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices("ab cd ef gh a a a".split(), k=rng.randint(0, 12))), rng.choice(["", " ", None, "a b", "x a x"])) for i in range(30)]
    texts = spark.createDataFrame(rows, "id long, one string, two string")
    found = []
    for together in (1, 4):
        monkeypatch.setattr(fingerprint, "TOGETHER", together)
        found.append({r.id: (r.one, r.two) for r in fingerprint.sampled(texts, ["id"], ["one", "two"]).collect()})
    assert found[0] == found[1] and len(found[0]) == 30
    for i, one, two in rows:
        assert [len(x) for x in found[1][i]] == [fingerprint.SAMPLES if (t or "").split() else 0 for t in (one, two)]
