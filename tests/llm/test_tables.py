"""Operators on tables: sharding, mixing, chat, and the pipeline."""

import collections
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import chat, mixing, sharding
from tidegate.llm.common import Scratch


def test_sharding(spark):
    rows = [(i, f"té {i % 17}") for i in range(3000)] + [(5, "té 5"), (None, "x"), (None, None), (7000, None), (7001, "")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, shard string")
    t = sharding.tree(24)
    got = sharding.shard(df, t, sharding.grow(t)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and (r.grown_shard == r.shard or r.grown_shard == 24)
    assert sorted(by) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(90 <= len(s) <= 165 for s in by.values())
    moved = sum(r.grown_shard == 24 for r in got)
    assert 80 <= moved <= 170
    text = dict(rows)
    for r in got:
        if r.doc_id is not None:
            raw = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    # rows without an id share a shard, but no salt
    none = spark.createDataFrame([(None, f"t{i}") for i in range(300)], "doc_id long, text string")
    lost = sharding.shard(none, t).collect()
    assert len({r.shard for r in lost}) == 1 and sorted(r.slot for r in lost) == list(range(300))
    assert sharding.shard(df.where("1 = 0"), t).isEmpty()
    carried = sharding.shard(df, t, carry=True)
    assert carried.select("row.*").columns == df.columns


def test_weights_and_confined_moves(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    t = {"a": {"r1": {0: 1.0, 1: 1.0}, "r2": {2: 2.0}}, "b": {"r3": {3: 4.0, 4: 0.0}}}
    heavier = {"a": {"r1": {0: 1.0, 1: 1.0}, "r2": {2: 2.0}}, "b": {"r3": {3: 1.0, 4: 3.0}}}
    got = ids.select(sharding.shard_of(F.col("k"), t).alias("x"), sharding.shard_of(F.col("k"), heavier).alias("y")).collect()
    share = [sum(r.x == s for r in got) / len(got) for s in range(5)]
    assert share == pytest.approx([1 / 8, 1 / 8, 1 / 4, 1 / 2, 0], abs=0.015)
    # only within b did weights change: its rows stay in b, all others where they were
    assert all(r.x == r.y or (r.x == 3 and r.y == 4) for r in got)
    # a heavier leaf makes its rack and region heavier: rows move into them from everywhere, and nowhere else
    bigger = {"a": {"r1": {0: 1.0, 1: 1.0}, "r2": {2: 2.0}}, "b": {"r3": {3: 9.0, 4: 0.0}}}
    moved = [(r.x, r.y) for r in ids.select(sharding.shard_of(F.col("k"), t).alias("x"), sharding.shard_of(F.col("k"), bigger).alias("y")).collect() if r.x != r.y]
    assert {x for x, _ in moved} == {0, 1, 2} and {y for _, y in moved} == {3}
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("k"), {"a": {"r": {0: 0.0}}})


def brute_targets(totals):
    names = sorted(k for k in totals if k is not None) + [None] * (None in totals)
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        rest = 1.5 * sum(totals.values()) - sum(2 * totals[s] for s in full)
        free = [s for s in names if s not in full]
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > 2 * totals[s]}
        if not over:
            return t | {s: 2 * totals[s] for s in full}
        full |= over


def test_targets(spark):
    for totals in ({"a": 10, "b": 1000, None: 50, "c": 0}, {"x": 5}, {}, {"b": 1, "a": 1, "é": 100, "z": 7}, {f"s{i}": i * i * 37 % 1000 + (i == 7) * 10**6 for i in range(60)}):
        df = spark.createDataFrame([*totals.items()], "source string, total long").select(mixing.source_key(F.col("source")).alias("key"), "total", "source")
        got = {r.source: r.target for r in mixing.targets(df, Scratch(spark, "t")).collect()}
        assert got == pytest.approx(brute_targets(totals)) if totals else got == {}
        assert sum(got.values()) == pytest.approx(1.5 * sum(totals.values()))


def dense_rates(sizes, target, cap=2.0):
    """Entropy balancing of one source by bisection on every document's own rate."""
    x = np.array(sizes, float)
    at = lambda lam: np.minimum(cap, np.exp(np.minimum(lam * x, 50)))
    lo, hi = -1e6, 1e6
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (at(mid) * x).sum() < target else (lo, mid)
    return at((lo + hi) / 2)


def test_rates_are_entropy_balanced(spark):
    """Against a dense solver; the rates differ within a source and meet its target, and no other such rates are nearer to 1."""
    rng = np.random.default_rng(3)
    sizes = {s: rng.integers(1, top, n).tolist() for s, top, n in (("a", 50, 40), ("b", 2000, 300), ("c", 20_000, 500), ("d", 5, 30), ("e", 400, 2))}
    rows = [(s, x) for s, xs in sizes.items() for x in xs]
    df = spark.createDataFrame([(i, " ".join(["w"] * x), s) for i, (s, x) in enumerate(rows)], "doc_id long, text string, source string")
    got = mixing.mix(df, Scratch(spark, "t")).select("row.source", "size", "target", "rate", "copies").collect()
    for s, xs in sizes.items():
        mine = sorted((r.size, r.rate) for r in got if r.source == s)
        target = next(r.target for r in got if r.source == s)
        want = dense_rates([x for x, _ in mine], target)
        assert [r for _, r in mine] == pytest.approx(want, rel=1e-6)
        assert sum(x * r for x, r in mine) == pytest.approx(target, rel=1e-8)
        assert len({r for _, r in mine}) > 1 or target == 2 * sum(xs)
        x, r = (np.array(c, float) for c in zip(*mine, strict=True))
        cost = lambda r: (r * np.log(np.maximum(r, 1e-300)) - r).sum()
        assert cost(r) <= cost(np.full(len(r), target / x.sum())) + 1e-9


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 90)), [None, "a", "b", "c", "d"][i % 5 if i % 3 else 1]) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", None), (1002, "\t\n ", "b"), (3, rows[3][1], rows[3][2]), (None, "x y", "a")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, source string, key string, rank int")
    got = mixing.mix(df, Scratch(spark, "t")).select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "copies").collect()
    assert len(got) == len(rows)
    totals, taken, smallest = {}, {}, {}
    for r in got:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.size == n and 0 <= r.copies <= 2
        totals[r.source] = totals.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + r.copies * n
        if n:
            smallest[r.source] = min(smallest.get(r.source, n), n)
    want = brute_targets(totals)
    for r in got:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= max(2, smallest[s]) for s in totals)
    again = mixing.mix(df, Scratch(spark, "t")).select("row.doc_id", "copies").collect()
    assert sorted((r.doc_id or 0, r.copies) for r in got) == sorted((r.doc_id or 0, r.copies) for r in again)
    out = mixing.mixed_rows(df, Scratch(spark, "t"))
    assert out.columns == df.columns and out.count() == sum(r.copies for r in got)
    assert mixing.mix(df.where("1 = 0"), Scratch(spark, "t")).isEmpty()


def snapshots():
    convs, i = {}, 0
    for base in range(6):
        turns = [("user" if k % 2 == 0 else "assistant", f"hi {k}" if k == 0 else f"{base} says {k}") for k in range(5)]
        for n in (1, 3, 5, 5):
            convs[i] = turns[:n]
            i += 1
    convs[50] = [("user", "hi 0"), ("assistant", "else")]
    convs[51] = [("user", None), (None, "")]
    convs[52] = [("user", "<|im_end|> trick")]
    return convs


def test_chat(spark, monkeypatch):
    convs = snapshots()
    rows = [(c, k, r, t, "x") for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    rows += [rows[0], (None, 0, "user", "no id", "x"), (60, None, "system", "null turn", "x"), (60, 0, "user", "hi 0", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string")
    whole = {c: tuple((r or "unknown", t or "") for r, t in turns) for c, turns in convs.items()}
    keep = {}
    for c, t in sorted(whole.items()):
        if not any(len(o) > len(t) and o[: len(t)] == t for o in whole.values()):
            keep.setdefault(t, []).append(c)
    show = lambda t: "".join(f"<|im_start|>{r}\n{x.replace('<|im_', '<im_')}<|im_end|>\n" for r, x in t)
    want = {(cs[0], len(cs), show(t)) for t, cs in keep.items()} | {(None, 1, show([("user", "no id")])), (60, 1, show([("system", "null turn"), ("user", "hi 0")]))}

    def got():
        parts = {}
        for r in chat.chat(df, Scratch(spark, "t")).orderBy("conv_id", "part").collect():
            parts.setdefault((r.conv_id, r.copies), []).append((r.part, r.text))
        assert all([p for p, _ in v] == list(range(len(v))) for v in parts.values())
        return {(*k, "".join(t for _, t in v)) for k, v in parts.items()}

    assert got() == want
    monkeypatch.setattr(chat, "SEGMENT", 2)  # long conversations go over several segments
    assert got() == want
    assert chat.chat(df.where("1 = 0"), Scratch(spark, "t")).isEmpty()


def test_chat_tells_no_id_from_its_name(spark):
    rows = [(None, 0, "user", "one"), ("null", 0, "user", "two"), ("none", 0, "user", "three"), ("=none", 0, "user", "four")]
    got = chat.chat(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), Scratch(spark, "t")).collect()
    assert {(r.conv_id, r.n_messages) for r in got} == {(None, 1), ("null", 1), ("none", 1), ("=none", 1)}


def test_chat_goes_by_the_order_of_turns(spark, monkeypatch):
    """Renumbered snapshots collapse; a turn of many messages comes in bounded rows, in order."""
    rows = [(1, t, "user", f"m{t}") for t in (0, 1, 2)] + [(2, t + 7, "user", f"m{t}") for t in (0, 1)] + [(3, 5 * t, "user", f"m{t}") for t in (0, 1, 2)]
    rows += [(4, 0, "user", "m0"), (4, 0, "user", "m1")]  # one turn of two messages is not two turns
    schema = "conv_id long, turn long, role string, text string"
    got = {r.conv_id: r for r in chat.chat(spark.createDataFrame(rows, schema), Scratch(spark, "t")).collect()}
    assert {c: r.copies for c, r in got.items()} == {1: 2, 4: 1} and got[1].n_messages == 3
    many = spark.range(50_000).selectExpr("id % 2 conv_id", "cast(null as long) turn", "'user' role", "concat(lpad(id, 6, '0'), repeat('x', 60)) text")
    monkeypatch.setattr(chat, "BYTES", 20_000)
    got = chat.chat(many, Scratch(spark, "t")).orderBy("conv_id", "part").collect()
    assert max(len(r.text) for r in got) < 80_000 and max(r.n_messages for r in got) <= 1024
    for c in (0, 1):
        mine = [r for r in got if r.conv_id == c]
        assert [r.part for r in mine] == list(range(len(mine))) and sum(r.n_messages for r in mine) == 25_000
        assert re.findall("[0-9]{6}", "".join(r.text for r in mine)) == [f"{i:06d}" for i in range(c, 50_000, 2)]


def test_native_operators_run_no_python(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    c = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for q in (sharding.shard(df, sharding.tree(24), sharding.grow(sharding.tree(24))), chat.chat(c, Scratch(spark, "t"))):
        assert not re.search("Python|Arrow|Pandas", q._jdf.queryExecution().toString())


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and repeated rows, a clashing column; and no rows at all."""
    import corpus_pipeline as p

    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n", None, "b", 3), (4, "plain words of a text", "en", "a", -1), (4, "plain words of a text", "en", "a", -1), (4, "quite another text of it", "en", "a", 24), (None, "no id but some words", "en", "c", 20), (5, long, "en", "b", len(long)), (6, long + " x", "en", "b", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, shard int"
    for name, these in (("some", rows), ("none", [])):
        d = tmp_path / name
        spark.createDataFrame([(*r, "r", 7) for r in these], schema).write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([(4, 1, 0), (None, 0, 1)] if these else [], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
        spark.createDataFrame([(1, None), (2, ""), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")] if these else [], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
        docs, scratch, seen = spark.read.parquet(str(d / "documents.parquet")), Scratch(spark, "t"), {}
        for stage, f in p.STAGES:
            docs = scratch.keep(f(spark, docs, str(d)))
            seen[stage] = docs.collect()
            if stage != "sharding":
                assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        if not these:
            assert not any(seen.values())
            continue
        assert len(seen["quality"]) == len(rows)
        texts = sorted(str((r.doc_id, (r.text or "")[:20], r.text is None)) for r in seen["near_duplicates"])
        assert len(texts) == 8 and sum("plain" in t or "quite" in t for t in texts) == 2 and not any(t.startswith("(6,") for t in texts)
        big = next(r for r in seen["decontamination"] if r.doc_id == 5)
        assert big.text.startswith("w0 w12 ") and big.n_chars == len(big.text) and len(seen["decontamination"]) == 8
        assert all((r.text or "").strip() for r in seen["mixing"]) and {r.row for r in seen["mixing"]} == {"r"}
        assert len(seen["sharding"]) == len(seen["mixing"])


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as p

    from tests.llm.test_texts import SCHEMA, brute_hits, corpus

    rows, labels = corpus(300)
    passage = " ".join(f"bench{i}" for i in range(15))
    rows = [(i, f"{t} {passage} tail" if i in (1, 2) else t, *r) for i, t, *r in rows]
    rows += [(500 + i, rows[i][1], *rows[i][2:]) for i in (1, 3, 6, 8)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen, scratch = {}, Scratch(spark, "t")
    for name, stage in p.STAGES:
        docs = scratch.keep(stage(spark, docs, str(tmp_path)))
        seen[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert not {r.doc_id for r in seen["near_duplicates"]} & {501, 503, 506, 508} and 1 in {r.doc_id for r in seen["near_duplicates"]}
    assert all(brute_hits(r.text, [(1, passage)])[1] == 0 for r in seen["decontamination"])
    one = next(r for r in seen["decontamination"] if r.doc_id == 1)
    assert one.text.endswith(" tail") and one.n_chars == len(one.text)
    assert len(seen["sharding"]) == len(seen["mixing"]) == p.run(spark, str(tmp_path)).count()


def test_white_space_of_any_length_is_counted_in_linear_time(spark):
    blank = {"spaces": " " * 5_000_000, "tabs": "\t" * 5_000_000, "mixed": " \t\n\x0b\x0c\r" * 800_000}
    texts = [f(x) for x in blank.values() for f in (lambda x: x, lambda x: "a" + x + "b", lambda x: x + "a", lambda x: "a" + x)]
    began = time.perf_counter()
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", mixing.size_of(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [0, 2, 1, 1] * 3
    assert time.perf_counter() - began < 60


def test_rows_that_tie_in_id_mix_alike_in_any_order(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, 5]), " ".join(rng.choices("abcdefgh", k=rng.choice([3, 7]))), rng.choice(["s", "t", None]), {"k": i % 3}) for i in range(440)]
    rows.append((None, "a" + " " * 300_000 + "b", "s", None))
    kept = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[1])):
        df = spark.createDataFrame(order, "doc_id long, text string, source string, more map<string,int>").repartition(3)
        kept.append(collections.Counter((r.doc_id, r.text, r.source, str(r.more)) for r in mixing.mixed_rows(df, Scratch(spark, "t")).collect()))
    assert kept[0] == kept[1] == kept[2]
