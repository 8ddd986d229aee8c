import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from folioforge.llm import components, mixing, near_duplicates, neighbours, packing
from folioforge.llm.textform import words


def likeness(a, b):
    s = lambda x: {tuple(w[i : i + 3]) for w in [words((x[0] or "") + " " + x[1])] for i in range(len(w) - 2)}
    return len(s(a) & s(b)) / len(s(a) | s(b))


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"mot{i}" for i in range(400)]
    fresh = lambda n: rng.choices(vocabulary, k=n)
    rows = []
    for g in range(12):
        base = fresh(120)
        for v in range(6):
            w = list(base)
            for _ in range(rng.choice([0, 1, 3, 8, 20])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((f"c{g}-{v}", rng.choice([None, "titre un"]), " ".join(w)))
    rows += [("short", "t", "trop court"), ("null", "t", None), rows[0], rows[5]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "chunk_id string, slide_title string, text string, node int")
    texts = {k: (t, x) for k, t, x in rows if x and len(words(x)) >= 20}
    want = {(a, b) for a in texts for b in texts if a < b and likeness(texts[a], texts[b]) >= 0.6}
    for cap in (200, 2):  # 2: every bucket goes through the block join
        got = {tuple(r) for r in near_duplicates.near_duplicate_pairs(df, cap=cap).collect()}
        assert got == want, cap
    groups = {r.key: r for r in near_duplicates.near_duplicate_groups(df).collect()}
    assert set(groups) == set(texts) and all(groups[a]["class"] == groups[b]["class"] for a, b in want)
    monkeypatch.setattr(near_duplicates, "ALL_PAIRS_OF_COPIES", 3)
    many = spark.createDataFrame([(f"k{i}", "", " ".join(vocabulary[:60])) for i in range(9)], "chunk_id string, slide_title string, text string")
    assert {tuple(r) for r in near_duplicates.near_duplicate_pairs(many).collect()} == {("k0", f"k{i}") for i in range(1, 9)}
    assert near_duplicates.near_duplicate_pairs(df.limit(0)).count() == 0


def test_copies_stored_differently(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "ALL_PAIRS_OF_COPIES", 3)
    vocabulary = [f"mot{i}" for i in range(60)]
    plain, edited = " ".join(vocabulary), " ".join([*vocabulary[:55], "ajout"])
    variants = [plain.upper(), plain.replace(" ", ", "), plain.replace(" ", "\n"), plain.replace("m", "m\u200b"), plain.replace("mot1 ", "ｍｏｔ１ "), plain + "."]
    rows = [(f"k{i}", "", t) for i, t in enumerate(variants)] + [(f"m{i}", "", plain) for i in range(5)] + [("z0", "", edited), ("z1", "", edited.upper()), ("k0", "", variants[0])]
    df = spark.createDataFrame(rows, "chunk_id string, slide_title string, text string")
    standing = sorted({k for k, _, _ in rows} - {f"m{i}" for i in range(1, 5)})
    want = {(a, b) for a in standing for b in standing if a < b} | {("m0", f"m{i}") for i in range(1, 5)}  # only equal stored texts go by their smallest key
    got = [tuple(r) for r in near_duplicates.near_duplicate_pairs(df).collect()]
    assert set(got) == want and len(got) == len(want)


def test_pruning_bound_misses_few():
    rng = np.random.default_rng(0)
    for n in (32, 64, 160):
        least = near_duplicates.least_matches(n, 0.6, 1e-4)
        assert (rng.binomial(n, 0.6, 100_000) < least).mean() < 1e-3 and (rng.binomial(n, 0.15, 100_000) >= least).mean() < 0.3


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (5000, 5000)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r["class"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 96))
    x[100:110] = x[5]  # one direction in several lengths
    x[100:105] *= 3
    x[110:130] = x[7] + rng.normal(size=(20, 96)) * 0.05  # a crowded region
    rows = [(f"v{i:03}", v.tolist(), 1.0) for i, v in enumerate(x)] + [("null", None, 1.0), ("zero", [0.0] * 96, 1.0), ("short", [1.0] * 64, 1.0), ("nan", [float("nan")] * 96, 1.0), ("v000", x[0].tolist(), 2.0)]
    df = spark.createDataFrame(rows, "chunk_id string, embedding array<float>, cosine double")
    near = neighbours.nearest_vectors(df, probes=256)  # all axes: exact
    got = defaultdict(list)
    for r in near.orderBy("chunk_id", "rank").collect():
        got[r.chunk_id].append(r.neighbour)
    u = x.astype(np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    c = np.round(u @ u.T, 6)
    assert len(got) == 150 and all(len(v) == 10 for v in got.values())
    for i in range(150):
        least = sorted((c[i, j] for j in range(150) if j != i), reverse=True)[9]
        assert all(c[i, int(n[1:])] >= least - 1e-5 for n in got[f"v{i:03}"]) and f"v{i:03}" not in got[f"v{i:03}"]
    assert neighbours.recall(df, near, one_in=3).first()["recall"] == 1.0
    assert neighbours.nearest_vectors(df.limit(0)).count() == 0
    y = neighbours.rotate(u.astype(np.float32), neighbours._signs(1, 128)[0])
    assert np.allclose(np.linalg.norm(y, axis=1), 1, atol=1e-4)


def test_neighbours_whole_and_lean(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "KEYS", 4)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 96)).astype(np.float32)
    x[:40] = x[50] + rng.normal(size=(40, 96)) * 0.3
    x[100:115] = x[99] * 2  # 16 keys of one class, in two rows
    x[200:260, 5:] = 0  # all length on few axes: the bound rules nothing out
    df = spark.createDataFrame([(f"v{i:04}", v.tolist()) for i, v in enumerate(x)], "chunk_id string, embedding array<float>")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before = written()
    rows = neighbours.nearest_vectors(df).orderBy("chunk_id", "rank").collect()
    assert written() - before < 4 * x.nbytes  # with an ORDER BY of the whole result in it; blocks were once copied some 60 times
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    c = np.round(u @ u.T, 9)
    np.fill_diagonal(c, -3)
    order = np.lexsort((np.broadcast_to(np.arange(3000), c.shape), -c), axis=1)[:, :10]
    assert len(rows) == 30_000 and [int(r.neighbour[1:]) for r in rows] == order.ravel().tolist()
    near = {(r.chunk_id, r.neighbour) for r in rows if r.cosine >= 0.8}
    assert {(r.chunk_id, r.neighbour) for r in neighbours.nearest_vectors(df, least=0.8).collect()} == near and len(near) > 300


def test_packing_patterns():
    rng = random.Random(8)
    for _ in range(60):
        counts = {rng.randint(1, 70): rng.randint(1, 50) for _ in range(rng.randint(0, 40))}
        made = packing.shortest_pack_first(counts, 70)
        held = Counter()
        for copies, pattern in made:
            assert sum(pattern) <= 70 and copies > 0
            for x in pattern:
                held[x] += copies
        assert held == Counter(counts)


def test_packing(spark):
    rng = random.Random(6)
    blocks = [(s, g, b, " ".join(["m"] * rng.choice([0, 3, 40, 200, 699, 700, 701, 1500])), "x") for s in "ab" for g in range(6) for b in range(20)]
    rows = blocks + [blocks[0], ("a", 9, 9, None, "x"), (None, 1, 1, "m", "x"), ("a", None, 1, "m", "x")]
    df = spark.createDataFrame(rows, "source string, group_ord int, block_ord int, text string, length string")
    packed = packing.pack_items(df, "source", ["group_ord", "block_ord"], "text").collect()
    fill, seen = Counter(), defaultdict(list)
    for r in packed:
        if r.pack is not None:
            fill[r.source, r.pack] += r.length
        else:
            assert r.length == 0
        seen[r.source, r.group_ord, r.block_ord].append(r)
    assert max(fill.values()) <= 700 and set(seen) == {b[:3] for b in blocks} | {("a", 9, 9)}
    for s, g, b, t, _ in blocks:
        own = sorted(seen[s, g, b], key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(t.split()) and (len(own) > 1) == (len(t.split()) > 700)
    for s in "ab":
        total = sum(n for (x, _), n in fill.items() if x == s)
        used = [k for x, k in fill if x == s]
        assert sorted(used) == list(range(len(used))) and len(used) <= 1.3 * total / 700 + 2
    texts = {(r.source, r.pack): r for r in packing.pack_texts(df, "source", ["group_ord", "block_ord"], "text").collect()}
    assert {k: len(r.text.split()) for k, r in texts.items()} == dict(fill) == {k: r.token_count for k, r in texts.items()}
    assert packing.pack_items(df.limit(0), "source", ["group_ord", "block_ord"], "text").count() == 0


def rounded(*a):
    return {k: round(v, 6) for k, v in mixing.budgets(*a).items()}


def test_budgets():
    s = lambda n, share, repeats, tokens, lang: {"source": n, "share": share, "repeats": repeats, "tokens": tokens, "language": lang}
    got = rounded([s("a", 0.4, 1, 100, "fr"), s("b", 0.2, 1, 10_000, "fr"), s("c", 0.4, 2, 10_000, "en")], 1000)
    assert got == {"a": 100.0, "b": 500.0, "c": 400.0}  # the sibling takes a's shortage first
    got = rounded([s("a", 0.4, 1, 100, "fr"), s("b", 0.2, 1, 300, "fr"), s("c", 0.4, 2, 10_000, "en")], 1000)
    assert got == {"a": 100.0, "b": 300.0, "c": 600.0}  # what the language cannot use goes up
    assert rounded([s("a", 1.0, 0, 100, None)], 50) == {"a": 0.0}


def test_mixing(spark):
    rng = random.Random(7)
    docs = [(i, "mot " * rng.randint(1, 60), rng.choice(["a", "a", "a", "b", "c", None, "other"]), "fr") for i in range(400)] + [(900, None, "a", "fr"), (901, "", "a", None)]
    df = spark.createDataFrame(docs + docs[:5], "doc_id bigint, text string, source string, lang string")
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.5, 3), ("c", 0.3, 2), ("none", 0.0, 4)], "source string, target_share double, max_repeats int")
    corpus, report = mixing.mix_sources(df, targets, 6000)
    rows, uses = {r.source: r for r in report.collect()}, corpus.collect()
    assert len({r.doc_id for r in uses}) == len(uses) and set(rows) == {"a", "b", "c", "none"}
    for s, r in rows.items():
        own = [u for u in uses if u.source == s]
        assert sum(u.tokens * u.copies for u in own) == r.used <= r.budget and all(u.copies <= r.max_repeats for u in own)
        assert r.budget - r.used <= 70
    assert abs(sum(r.actual_share for r in rows.values()) - 1) < 1e-9
    assert {tuple(r) for r in mixing.mix_sources(df, targets, 6000)[0].collect()} == {tuple(r) for r in uses}
    assert mixing.written_out(corpus).groupBy("doc_id").count().agg(F.sum("count")).first()[0] == sum(u.copies for u in uses)
    assert mixing.mix_sources(df.limit(0), targets)[0].count() == 0
