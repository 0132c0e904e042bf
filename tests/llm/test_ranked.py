"""Rules, manifest and search against brute force on small odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidegate.llm import merkle, rules, search
from tidegate.llm.common import Scratch, bound_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, prefix string, words string, term string"


def table(spark, rows):
    """Documents, with further columns whose names the operators use inside."""
    bound_batches(spark)
    return spark.createDataFrame([(*r, "g", "p", "w", "t") for r in rows], SCHEMA)


def odd_rows(seed=1, n=300):
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "δέλτα", "epsilon", "a", "the", "$$", "x-y", "12"]
    rows = []
    for i in range(n):
        text = rnd.choice([None, "", " \t\n", " ".join(rnd.choices(words, k=rnd.randint(1, 40))), "same words again and again in this text here"])
        rows.append((rnd.choice([i, i - 7, 5, None, -3, 2**40 + i]), text, rnd.choice(["en", "fr", None, "", "é"]), rnd.choice(["s", None]), rnd.choice([None, 3])))
    return rows


# ---- rules


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    hit = {i + o for at in windows.values() if len(at) > 1 for i in at for o in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_counts_of_any_text(spark):
    texts = [None, "", " \t", "a", "a a a a a", "a a a a a a", "a b c d e f a b c d e", "x\nx\n \n\nx\r\nx", "# * $ % & | < >", "é" * 9 + "\x0b\U0001f600   b"]
    texts += [r[1] for r in odd_rows(2)] + ["one two three four five six " * 3000, " " * 200_000 + "a" + "\t" * 200_000, "z" * 300_000]
    got = rules.measured(table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)}


def test_estimation_finds_the_rules_accuracies(spark):
    rnd = random.Random(3)
    k = len(rules.RULES)
    right_good, right_bad, voting = [0.97 - 0.01 * j for j in range(k)], [0.4 + 0.05 * j for j in range(k)], [0.5 + 0.05 * j for j in range(k)]
    votes = Counter()
    for _ in range(20_000):
        good = rnd.random() < 0.8
        row = []
        for j in range(k):
            right = rnd.random() < (right_good if good else right_bad)[j]
            row.append(1 if rnd.random() > voting[j] else 2 * (good == right))
        votes[tuple(row)] += 1
    patterns = spark.createDataFrame([(list(v), n) for v, n in votes.items()], "votes array<int>, n long")
    m, more = rules.estimate(patterns), rules.estimate(patterns, rules.ROUNDS + 5)
    assert abs(m.good - 0.8) < 0.03 and abs(m.good - more.good) < 1e-3
    assert max(abs(a - b) for a, b in zip(m.on_good, right_good)) < 0.03
    assert max(abs(a - b) for a, b in zip(m.on_bad, right_bad)) < 0.06


def test_without_documents_the_model_is_its_start(spark):
    none = spark.createDataFrame([], "votes array<int>, n long")
    m = rules.estimate(none, 3)
    assert math.isclose(m.good, rules.START.good) and all(map(math.isclose, m.on_good, rules.START.on_good))


def test_votes_abstain_or_tell(spark):
    text = {"clean": "The house of the lord is in the middle of a town. It is old and was built with stone.", "table": "aaa | bbb | " * 40, "shout": "WHAT!! IS!! THIS!! " * 20}
    got = rules.measured(table(spark, [(i, t, None, None, None) for i, t in enumerate(text.values())])).withColumn("v", rules.votes_of(rules.pattern()))
    at = {name: i for i, name in enumerate(rules.RULES)}
    clean, tab, shout = (r.v for r in got.orderBy("doc_id").collect())
    assert 0 not in clean and clean[at["lines"]] == 1
    assert tab[at["symbols"]] == 0 and tab[at["function_words"]] == 0
    assert shout[at["capitals"]] == 0 and shout[at["exclamations"]] == 0


def test_verdicts_of_odd_rows_and_none(spark):
    rows = odd_rows(4)
    out = rules.judged(table(spark, rows), Scratch(spark, "t")).collect()
    assert len(out) == len(rows)
    assert all(not r.kept for r in out if r.base_failed)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in out)
    again = rules.judged(table(spark, rows[::-1]), Scratch(spark, "t")).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(out, key=key) == sorted(again, key=key)
    assert rules.judged(table(spark, []), Scratch(spark, "t")).count() == 0


# ---- manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(rows):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    leaf = lambda i, s, la, n, t: h(enc(i), enc(s), enc(la), enc(n), enc(t))
    groups = defaultdict(list)
    for i, t, la, s, n in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        x = leaf(i, s, la, n, t)
        groups[la].append((i is not None, i or 0, x, i, leaf(i, s, la, n, lower(t)) if hit else x))
    up = lambda nodes: [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append(up(out[-1]))
        return out

    trees = {la: levels([x[2] for x in sorted(g)]) for la, g in groups.items()}
    names = sorted(trees, key=lambda la: (la is not None, (la or "").encode()))
    over = levels([trees[la][-1][0] for la in names])
    out = []
    for la, g in groups.items():
        for p, (_, _, x, i, tampered) in enumerate(sorted(g)):
            proof, at = "", tampered
            for tree, q in ((trees[la], p), (over, names.index(la))):
                for nodes in tree[:-1]:
                    run = nodes[q // 8 * 8 : q // 8 * 8 + 8]
                    left, right = "".join(run[: q % 8]), "".join(run[q % 8 + 1 :])
                    proof, at, q = proof + left + right, h(left, at, right), q // 8
            out.append((i, x, trees[la][-1][0], over[-1][0], h(proof), at, at == over[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("most", [merkle.MOST, 20])
def test_manifest_of_odd_rows(spark, most):
    rows = odd_rows(5, 900) + [(None, "copy", "en", None, None)] * 40 + [(77, f"T{i}", "en", None, i) for i in range(60)]
    got = merkle.checked(table(spark, rows), Scratch(spark, "t"), most).collect()
    assert Counter(map(tuple, got)) == brute_tree(rows)


def test_manifest_of_few_rows(spark):
    for rows in ([(3, "A", None, None, None)], [(3, None, "en", "s", 1), (4, "B", "fr", None, 2)], [(i, "x", f"l{i:03}", None, i) for i in range(70)]):
        assert Counter(map(tuple, merkle.checked(table(spark, rows), Scratch(spark, "t"), 16).collect())) == brute_tree(rows)
    assert merkle.checked(table(spark, []), Scratch(spark, "t")).count() == 0


def test_manifest_tells_changed_rows(spark):
    """Rows whose leaf still gives the root are unchanged, all others aren't."""
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(600)]
    m = merkle.manifest(table(spark, rows), Scratch(spark, "t"))
    p = m.proofs().select("own.doc_id", "leaf", "root", "path")
    other = F.when(F.col("doc_id") % 7 == 0, merkle.digest(F.lit("x"))).otherwise(F.col("leaf"))
    wrong = p.where(merkle.folded(other, F.col("path")) != F.col("root")).collect()
    assert {r.doc_id for r in wrong} == set(range(0, 600, 7))
    assert [tuple(r) for r in m.groups.select("name", "n").collect()] == [("=en", 600)]


# ---- search


def brute_search(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = [(i, Counter(terms(t))) for i, t, *_ in docs if terms(t)]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for i, c in held:
            m = 25 + 75 * c.total() * n // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, times in asked.items() if c[t])
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out.update((item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k]))
    return out


@pytest.mark.parametrize("most", [search.MAX_PAIRS, 90])
def test_search_of_odd_rows(spark, most):
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(200)] + ["Ünder", "日本語", "A1"]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda a, b: " ".join(rnd.choices(vocabulary, weight, k=rnd.randint(a, b)))
    docs = odd_rows(7) + [(i, text(1, 80), None, None, None) for i in range(500)] + [(9, "copied w150 w151", None, None, None)] * 40 + [(i, "w150 w151 copied", None, None, None) for i in range(60)]
    docs += [(1, "w3 " * 50_000, None, None, None), (2, "-" * 100_000 + "w199", None, None, None)]
    items = [(i, text(3, 30)) for i in range(12)] + [(1, "w150 w150 copied W151"), (None, "w199, 日本語"), (20, None), (21, "--"), (22, "unknown"), (23, "the THE beta")]
    frame = spark.createDataFrame([(*x, "t") for x in items], "item_id long, text string, item string")
    got = search.search(table(spark, docs), frame, Scratch(spark, "t"), most_pairs=most, most_items=9 if most == 90 else search.MAX_ITEMS)
    assert Counter(map(tuple, got.collect())) == brute_search(docs, items)


def test_search_of_nothing(spark):
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.search(table(spark, []), some, Scratch(spark, "t")).count() == 0
    assert search.search(table(spark, [(1, "a", None, None, None)]), some.limit(0), Scratch(spark, "t")).count() == 0
    assert search.search(table(spark, [(1, None, None, None, None)]), some, Scratch(spark, "t")).count() == 0


def test_bounds_hold_the_impacts():
    tf, m = [x.ravel() for x in __import__("numpy").meshgrid([1, 2, 7, 1000, 10**6], [25, 100, 10**4, 10**7, 10**9])]
    exact = search._exact(tf, m)
    q = -(-exact // search.STEP)
    assert q.max() <= 255 and (exact <= q * search.STEP).all() and ((q == 0) | (exact > (q - 1) * search.STEP)).all()
