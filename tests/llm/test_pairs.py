"""Embedding and MinHash near-duplicates, and components, against brute force."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tidegate.llm import embedding, minhash
from tidegate.llm.common import Scratch, likely_in, salted_rank
from tidegate.llm.components import connected_components
from tidegate.llm.embedding import embedding_links
from tidegate.llm.minhash import minhash_components, minhash_dedup


def closure(nodes, edges):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, i) for i in range(400, 700)] + [(i, i + 1) for i in range(800, 850)] + [(5, 5), (1, 2), (1, 2)]
    got = connected_components(spark.createDataFrame(edges + [(None, 3)], "a long, b long"), Scratch(spark, "t"))
    want = closure({x for e in edges for x in e}, edges)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.comp for r in got.collect()} == {n: c for n, c in want.items() if n in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).isEmpty()


def jaccard(a, b):
    return 100 * len(a & b), len(a | b)


def shingles(text):
    w = [x for x in "".join(c if c in " \t\n\r\x0b\x0c" or c > " " else c for c in (text or "")).translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def texts():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(500)]
    base = [[rng.choice(vocab) for _ in range(rng.choice((3, 8, 60, 120, 300)))] for _ in range(40)]
    out = [" ".join(b) for b in base]
    for b in base[:20]:  # near copies of a spread of similarities
        for n in (1, 2, 3, 5, 9):
            c = list(b)
            for _ in range(n):
                c[rng.randrange(len(c))] = rng.choice(vocab)
            out.append(" ".join(c))
    long = [rng.choice(vocab) for _ in range(200)]
    for i in range(60):  # a hub whose copies differ from each other more than from it
        c = list(long)
        for _ in range(3):
            c[rng.randrange(200)] = f"x{i}"
        out.append(" ".join(c))
    out += [out[3].upper(), out[3].replace(" ", "\t\n")] * 3 + [None, "", " \n", "É é", "é É", "one two", "ONE two", "one two three"]
    return out


def test_minhash(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, hi int")
    for percent in (80, 85):
        got = {r.doc_id: r for r in minhash_components(df, Scratch(spark, "t"), percent).collect()}
        sets = {i: shingles(t) for i, t in rows}
        links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and (lambda n, u: n >= percent * u)(*jaccard(sets[i], sets[j]))]
        want = closure(sets, links)
        assert {i: r.component_id for i, r in got.items()} == want
        assert all(r.n_shingles == len(sets[i]) and r.kept == (want[i] == i) for i, r in got.items())


def test_minhash_odd_rows(spark):
    t = "a b c d e f g h i j"
    df = spark.createDataFrame([(1, t), (1, t), (2, t), (None, t), (3, None), (3, "")], "doc_id long, text string")
    got = sorted(map(tuple, minhash_components(df, Scratch(spark, "t")).collect()), key=str)
    assert got == sorted([(1, 6, 1, True), (1, 6, 1, True), (2, 6, 1, False), (None, 6, None, None), (3, 0, 3, True), (3, 0, 3, True)], key=str)
    kept = minhash_dedup(df, Scratch(spark, "t"))
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.where("doc_id < 3 or doc_id is null").collect()) == [(False, 1, t), (True, None, t)]
    assert kept.columns == df.columns
    assert minhash_components(df.where("1 = 0"), Scratch(spark, "t")).isEmpty()


def test_minhash_links_rows_not_ids(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    near = b.replace("b30", "x")
    want = [(1, 56, 1, True), (1, 56, 1, True), (2, 56, 1, False)]
    for rows in ([(1, a), (1, b), (2, near)], [(1, b), (1, a), (2, near)], [(2, near), (1, a), (1, b)]):
        df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, th string").coalesce(1)
        assert sorted(map(tuple, minhash_components(df, Scratch(spark, "t")).collect())) == want
        kept = minhash_dedup(df, Scratch(spark, "t"))
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, a), (1, b)] and kept.columns == df.columns
    # an id apart from its other text's component
    df = spark.createDataFrame([(3, a), (3, b), (2, near)], "doc_id long, text string")
    assert sorted(map(tuple, minhash_components(df, Scratch(spark, "t")).collect())) == [(2, 56, 2, True), (3, 56, 2, False), (3, 56, 3, True)]
    assert sorted((r.doc_id, r.text) for r in minhash_dedup(df, Scratch(spark, "t")).collect()) == [(2, near), (3, a)]


def test_first_band_is_by_the_buckets_keys():
    """Minima that agree in 16 bits only share no bucket: a pair must not wait for one there."""
    sig = np.arange(160, dtype=np.uint32).reshape(1, -1).repeat(2, axis=0)
    sig[1, :5] += 1 << 16
    keys = [minhash.band_keys(x, 32, 5) for x in sig]
    low = [(x & 0xFFFF).astype(np.uint16).tobytes() for x in sig]
    cols = {"band": [1, 1], "key": [int(keys[0][1])] * 2, "p": [0, 0], "q": [0, 0], "side": [0, 0], "node": [1, 2], "n": [9, 9], "comp": [1, 2], "sig": low, "bands": keys}
    i, j = minhash._near_pairs(pa.table(cols), 0.5, 80, 1)
    assert (i.tolist(), j.tolist()) == ([0], [1])


def test_buckets_of_one_centre_are_dealt_together(spark):
    """Near copies share many buckets: each is dealt once, all that share a bucket meet, and in one group take the pair."""
    g = np.random.default_rng(5)
    n, bands = 900, 16
    inside = g.random((n, bands)) < 0.8
    inside[0] = True  # the centre of all buckets
    comp = np.where(np.arange(n) < 500, 0, np.arange(n))
    rows = [(b, 1000 + b, x, 100, int(comp[x])) for b in range(bands) for x in range(n) if inside[x, b]]
    rows += [(b, 2000 + b, 10_000 + 300 * b + x, 100, 10_000 + 300 * b + x) for b in range(2) for x in range(300)]  # one centre, nothing else in common
    rows += [(1, 2001, 10_000, 100, 10_000)]
    at = spark.createDataFrame(rows, "band int, key long, node long, n long, comp long")
    centre = spark.createDataFrame([(1000 + b, 0, 0) for b in range(bands)] + [(2000, 10_000, 10_000), (2001, 10_000, 10_000)], "key long, a long, ac long")
    got = minhash._meetings(at, centre, Scratch(spark, "t")).toPandas()
    hot = got[got.node < n]
    assert len(hot) <= n * 8  # before: each bucket on its own, 16 * 720 * 6
    assert set(got[got.node >= 10_000].band) == {0, 1}  # together they'd make more rows
    met = set()
    for _, x in hot.groupby(["band", "key", "p", "q"]):
        left, right = ((x.node[x.side == s]).tolist() for s in (0, 1))
        for i, j in itertools.combinations(left, 2) if x.p.iloc[0] == x.q.iloc[0] else itertools.product(left, right):
            if comp[i] != comp[j]:
                assert (min(i, j), max(i, j)) not in met
                met.add((min(i, j), max(i, j)))
    assert met >= {(i, j) for i in range(n) for j in range(max(i + 1, 500), n) if (inside[i] & inside[j]).any()}
    mask = hot.groupby("node")["mask"].first()
    assert all(mask[x] == sum(1 << b for b in range(bands) if inside[x, b]) for x in mask.index)


def test_minhash_of_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    df = spark.createDataFrame([(1, long), (2, long + " more"), (3, "a" * 2_000_000), (4, "other words of a short text here")], "doc_id long, text string")
    assert sorted(map(tuple, minhash_components(df, Scratch(spark, "t")).collect())) == [(1, 299_996, 1, True), (2, 299_997, 1, False), (3, 1, 3, True), (4, 3, 4, True)]


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def test_embedding(spark):
    rng = random.Random(5)
    rows, i = [], 0
    for label in (0, 1):
        for _ in range(40):
            v = [rng.gauss(0, 1) for _ in range(16)]
            for noise in (0, 0, 0.1, 0.25, 0.3, 0.5):
                rows.append((i, [x + rng.gauss(0, noise) if noise else x for x in v], label))
                i += 1
    hub = [rng.gauss(0, 1) for _ in range(16)]
    for _ in range(150):
        rows.append((i, [x + rng.gauss(0, 0.2) for x in hub], 2))
        i += 1
    odd = [(i + 1, None, 0), (i + 2, [0.0] * 16, 0), (i + 3, [float("nan")] * 16, 0), (i + 4, [None] * 16, 0), (i + 5, [float("inf")] + [1.0] * 15, 0), (i + 6, rows[0][1], None), (i + 7, rows[0][1][:8], 0), (i + 8, [], 0)]
    df = spark.createDataFrame([(a, b, c, 0) for a, b, c in rows + odd], "vec_id long, embedding array<double>, label int, node int")
    got = {r.vec_id: r for r in embedding_links(df, Scratch(spark, "t"), block=32).collect()}
    links = [(a[0], b[0]) for k, a in enumerate(rows) for b in rows[k + 1 :] if a[2] == b[2] and cosine(a[1], b[1]) >= 0.93]
    want = closure(got, links)
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    found = sum(r.n_links for r in got.values())
    assert found <= 2 * len(links) and found >= 0.999 * 2 * len(links)
    assert all(r.n_links <= n[k] for k, r in got.items())
    assert {k: r.component_id for k, r in got.items()} == want and all(r.kept == (r.component_id == k) for k, r in got.items())
    assert embedding_links(df.where("1 = 0"), Scratch(spark, "t")).isEmpty()


def test_components_of_any_size(spark):
    """Huge and tiny doubles link by their true cosine, worked out in decimals."""
    from decimal import Decimal as D

    vs = [[1e-200, 0.0], [0.5, 0.866], [1e200, 1e200], [1e200, 1.0001e200], [5e-324, 5e-324], [1e308, 1.7e308], [1e-308, 1.7e-308], [3e-200, 1e-210], [-1e200, -1e200], [1e200, 1e-200], [2e-310, 3e-310]]

    def cosine(a, b):
        a, b = [*map(D, a)], [*map(D, b)]
        norm = lambda v: sum((x * x for x in v), D(0)).sqrt()
        return sum((x * y for x, y in zip(a, b, strict=True)), D(0)) / (norm(a) * norm(b))

    got = {r.vec_id: r for r in embedding_links(spark.createDataFrame([(i, v, 1) for i, v in enumerate(vs)], "vec_id long, embedding array<double>, label int"), Scratch(spark, "t")).collect()}
    for i, v in enumerate(vs):
        assert got[i].n_links == sum(cosine(v, w) >= D("0.93") for j, w in enumerate(vs) if j != i), i


def test_dense_blocks_are_the_same_links(monkeypatch):
    monkeypatch.setattr(embedding, "DENSE", 1000)
    rng = np.random.default_rng(3)
    for same in (True, False):
        x = np.concatenate([rng.normal(size=(1, 8)) + rng.normal(size=(400, 8)) * 0.1 for _ in range(2)])
        norm = np.sqrt((x * x).sum(axis=1))
        codes = rng.integers(0, 2, (800, 3)).astype(np.int32)
        left = np.arange(800) if same else np.arange(0, 800, 2)
        right = left if same else np.arange(1, 800, 2)
        for t in (0, 2):
            found = embedding._Found(np.arange(800), np.arange(800) % 3 + 1)
            embedding._block_pairs(found, x, norm, codes, t, left, right, 0.93)
            near = ((x @ x.T) / norm[:, None] / norm[None, :] >= 0.93) & ~(codes[:, None, :t] == codes[None, :, :t]).any(axis=2)
            near = np.triu(near, 1) if same else near & (np.arange(800) % 2 == 0)[:, None] & (np.arange(800) % 2 == 1)[None, :]
            i, j = np.nonzero(near)
            assert len(i) > 1000 and (found.links == np.bincount(i, found.copies[j], 800) + np.bincount(j, found.copies[i], 800)).all()
            want = embedding._components(800, i, j)
            got = embedding._components(800, np.concatenate(found.i), np.concatenate(found.j))
            assert (want == got).all()


def test_embedding_labels_and_repeats(spark):
    v = [1.0, 0.0, 0.5]
    df = spark.createDataFrame([(1, v, 1.2), (2, v, 1.7), (3, v, 1.2), (4, [0.0, 1.0, 0.0], 1.2), (4, v, 1.2), (None, v, 1.2)], "vec_id long, embedding array<float>, label double")
    want = [(1, 2, 1, True), (2, 0, 2, True), (3, 2, 1, False), (4, 0, 4, True), (4, 2, 1, False), (None, 0, None, None)]
    assert sorted(map(tuple, embedding_links(df, Scratch(spark, "t")).collect()), key=str) == sorted(want, key=str)
    words = df.selectExpr("vec_id", "embedding", "concat('l', label) label")
    assert sorted(map(tuple, embedding_links(words, Scratch(spark, "t")).collect()), key=str) == sorted(want, key=str)


def test_embedding_blocks_of_any_size(spark, monkeypatch):
    """Small and large buckets, one or many blocks: the same links."""
    rng = np.random.default_rng(2)
    hub = rng.normal(size=12)
    rows = [(i, (hub + rng.normal(size=12) * (0.05 if i % 2 else 0.3)).tolist(), 0) for i in range(260)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = ((x @ x.T) >= 0.93).sum(axis=1) - 1
    for small, block in ((64, 2048), (2, 2048), (2, 40), (500, 40)):
        monkeypatch.setattr(embedding, "SMALL", small)
        got = {r.vec_id: r.n_links for r in embedding_links(df, Scratch(spark, "t"), block=block).collect()}
        assert sum(got.values()) >= 0.999 * n.sum() and all(got[i] <= n[i] for i in got)


def test_tables_and_work_follow_the_count(spark):
    """Twenty times the vectors: a vector meets less than three times as many strangers, in all tables; and near ones are found still."""
    rng = np.random.default_rng(7)
    work = {}
    for count in (2_000, 40_000):
        bits = count.bit_length() + 1
        tables = embedding.tables_for(bits, 0.93)
        x = rng.normal(size=(count, 64))
        met = 0
        for _ in range(3):
            code = ((x @ rng.normal(size=(64, bits)) > 0) * (1 << np.arange(bits))).sum(axis=1)
            n = np.unique(code, return_counts=True)[1]
            met += (n * (n - 1)).sum()
        work[count] = met / 3 * tables / count
    assert work[40_000] < 3 * work[2_000]
    agree = 1 - math.acos(0.93) / math.pi
    assert all((1 - agree**b) ** embedding.tables_for(b, 0.93) <= 1e-4 for b in range(8, 31))


def test_bitmap_loses_nothing(spark):
    df = spark.createDataFrame([(i,) for i in range(-500, 500)] + [(None,)], "x long")
    ids = df.where("x % 7 = 0")
    assert likely_in(df, "x", ids).join(ids, "x", "left_semi").count() == ids.count()
    assert likely_in(df, "x", ids.where("1 = 0")).isEmpty()


def test_rank_has_no_gaps(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a" if i % 3 else "b", i % 50) for i in range(500)], "k string, i int")
    got = salted_rank(df, ["k"], [F.col("i")], F.col("i"), "r", 8).collect()
    for k in "ab":
        r = sorted(x.r for x in got if x.k == k)
        assert r == list(range(len(r)))


def test_scratch_follows_the_session(spark):
    s = Scratch(spark, "t")
    assert s.root.startswith(spark.conf.get("spark.checkpoint.dir"))
    t = s.keep(spark.range(3))
    s.drop(t)
