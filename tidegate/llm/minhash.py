"""MinHash near-duplicates: universal hash minima, banding, signature
verification, exact confirmation and connected components.

A bucket of a band isn't expanded into all its pairs. First one centre of every
bucket, the member found in the largest buckets, is compared with the other
members; buckets whose members have come to one component need no more. The
rest is compared in blocks of bounded size, across components only, first by
signature, then by full sets; a block returns one link a member, not its
pairs. Near copies share most of their buckets, so buckets with one centre are
dealt to blocks together, each member once. A pair that shares several bands is
taken in the first, by the buckets' own keys, so that bands and signatures alone
decide what is missed.

Rows are what is linked, by the class of their shingle set; ids only name them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, likely_in, packed, spread, table
from tidegate.llm.components import SALTS, connected_components

SHINGLE = 5
#: 32 bands of 5 minima: a pair at similarity 0.80 shares none with probability
#: 3e-6, at 0.85 with 7e-9; SIGMAS refuses fewer than 1e-6 of those that do.
BANDS, ROWS = 32, 5
#: Members of a group compared at once; two blocks meet in one task's rows.
BLOCK = 128
#: Signatures may fall short of the threshold by so many standard errors
#: before a pair is refused without comparing its full sets.
SIGMAS = 5.0
_WORDS_CACHED = 150_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_CACHED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: dict, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's k-word shingles.

    A-Z are lowered; words are divided by ASCII white space. Fewer words than k
    are one shingle; no words, or no text, give an empty set.
    """
    if not text:
        return np.empty(0, np.uint64)
    # bytes.split() divides at exactly x20 and x09-x0D, bytes.lower() lowers A-Z only
    toks = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(toks)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, toks), dtype=np.uint64, count=n)
    m = min(k, n)
    acc = np.zeros(n - m + 1, np.uint64)
    for i in range(m):
        acc = _mix(acc + h[i : n - m + 1 + i] * _MULTIPLIERS[i % len(_MULTIPLIERS)] + np.uint64(i))
    if m < k:
        acc = _mix(acc + np.uint64(m))
    return np.unique(acc)


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add hashes (ax + b mod 2^64, upper 32 bits), a odd."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 2**64, n, dtype=np.uint64)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of each hash over a set, as uint32."""
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):  # stays in cache
        part = shingles[i : i + 2048]
        np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.arange(1, bands + 1, dtype=np.uint64)
    parts = sig.reshape(bands, rows).astype(np.uint64)
    for i in range(rows):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return acc.view(np.int64)


_SKETCH = pa.schema([("node", pa.int64()), ("th", pa.int64()), ("n_shingles", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sketcher(shingle: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_family(bands * rows, seed)
        words = _WordHashes()
        for batch in batches:
            out: list[tuple] = []
            for i, th, text in zip(*(batch.column(c).to_pylist() for c in ("node", "th")), batch.column("text"), strict=True):
                s = shingle_set(text.as_py(), words, shingle)
                if not len(s):
                    out.append((i, th, 0, None, None, None, None))
                    continue
                d = xxhash.xxh3_128_digest(s.tobytes())
                sig = minima(s, a, b)
                out.append((i, th, len(s), int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), (sig & 0xFFFF).astype(np.uint16).tobytes(), band_keys(sig, bands, rows)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), _SKETCH.types, strict=True)], schema=_SKETCH)

    return run


def _like_signatures(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
            ok = (x == y).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return run


def _near_pairs(g: pa.Table, least: float, percent: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a group's pairs, across its two blocks and components, that the signatures bear out.

    A pair is taken in the first band that it shares: if that is ``band``, or, below
    0, where the group has that band's bucket.
    """
    sig = np.frombuffer(b"".join(g["sig"].to_pylist()), np.uint16).reshape(g.num_rows, -1)
    keys = g["bands"].combine_chunks().flatten().to_numpy().reshape(g.num_rows, -1)
    n, comp, side = (g[c].to_numpy() for c in ("n", "comp", "side"))
    mask = g["mask"].to_numpy() if band < 0 else None
    within = g["p"][0] == g["q"][0]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    left = np.flatnonzero(side == 0)
    right = left if within else np.flatnonzero(side == 1)
    for k, i in enumerate(left):
        js = right[k + 1 :] if within else right
        js = js[(comp[js] != comp[i]) & (100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i]))]
        if not len(js):
            continue
        js = js[(sig[js] == sig[i]).mean(axis=1) >= least]
        if len(js):
            same = keys[js] == keys[i]
            first = same.argmax(axis=1)
            js = js[first == band] if mask is None else js[same.any(axis=1) & ((mask[i] >> (first % 64)) & 1 == 1)]
            found.append((np.full(len(js), i), js))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of rows sorted by (band, key, p, q)."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        k = np.stack([t[c].to_numpy() for c in ("band", "key", "p", "q")], axis=1)
        starts = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(axis=1))))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield t.slice(a, b - a)
        rest = t.slice(starts[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


_MET = ["band", "key", "p", "q", "side", "node", "n", "comp", "mask", "sig", "bands"]


def _meetings(at: DataFrame, centre: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of buckets with more than one component, dealt to blocks (p, q) of groups (band, key): two members of one bucket and two components meet.

    ``at``: band, key, node, n, comp. ``centre``: key, a (its centre), ac (that one's
    component). A group is all of one centre's buckets (band -1, key the centre), each
    member once, or one bucket where that makes fewer rows. mask has a bit for each
    band whose bucket is in the group (of 64; a band beyond shares a bit). Members of
    the centre's component don't meet each other.
    """
    mixed = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi")
    mixed = scratch.keep(mixed.select("key", "size").join(centre, "key"))
    parts = scratch.keep(at.join(mixed, "key").select("band", "key", "node", "n", "comp", F.expr("shiftleft(1L, band)").alias("mask"), "a", "ac"))
    # a member has one n and one component, whatever its bucket
    whole = scratch.keep(parts.groupBy("a", "node").agg(*[F.max(c).alias(c) for c in ("n", "comp", "ac")], F.bit_or("mask").alias("mask")))
    cost = lambda n: F.col(n) * F.ceil(F.col(n) / BLOCK)
    apart = mixed.groupBy("a").agg(F.sum(cost("size")).alias("apart"))
    apart = scratch.keep(whole.groupBy("a").agg(F.count(F.lit(1)).alias("size")).join(apart, "a").where(cost("size") > F.col("apart")).select("a"))
    cols = ["band", "key", "node", "n", "comp", "mask", "ac"]
    of = whole.join(apart, "a", "left_anti").withColumn("band", F.lit(-1)).withColumn("key", F.col("a")).select(cols)
    of = scratch.keep(of.union(parts.join(apart, "a", "left_semi").select(cols)))
    near = F.count(F.when(F.col("comp") == F.col("ac"), 1))
    blocks = of.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), near.alias("near"))
    blocks = blocks.withColumn("near", F.when(F.col("size") <= BLOCK, 0).otherwise(F.col("near")))  # one block for all
    # kept before it is joined back, as of too: a hot group can be split
    blocks = scratch.keep(blocks.select("band", "key", F.ceil(F.col("near") / BLOCK).cast("int").alias("x"), F.ceil((F.col("size") - F.col("near")) / BLOCK).cast("int").alias("y")))
    # blocks 0 to x - 1 are of the centre's component, y more of the others
    met = of.join(blocks, ["band", "key"]).withColumn("inner", (F.col("comp") == F.col("ac")) & (F.col("x") > 0))
    own = F.when(F.col("inner"), F.pmod(F.xxhash64("node"), F.greatest("x", F.lit(1)))).otherwise(F.col("x") + F.pmod(F.xxhash64("node"), F.col("y")))
    met = met.withColumn("own", own.cast("int")).withColumn("other", F.explode(F.sequence(F.when(F.col("inner"), F.col("x")).otherwise(0), F.col("x") + F.col("y") - 1)))
    return met.select("band", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "n", "comp", "mask")


def _block_likely(least: float, percent: int):
    """Of each group, the members that the signatures give a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _by_group(batches):
            i, j = _near_pairs(g, least, percent, g["band"][0].as_py())
            if len(i):
                yield from g.take(pa.array(np.union1d(i, j))).combine_chunks().to_batches()

    return run


def _block_links(least: float, percent: int, shingle: int):
    """Of each group with texts, links that the full sets bear out and that join its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for g in _by_group(batches):
            sets: dict[int, np.ndarray] = {}
            top = list(range(g.num_rows))

            def find(x: int, top=top) -> int:
                while top[x] != x:
                    top[x] = top[top[x]]
                    x = top[x]
                return x

            out: list[tuple[int, int]] = []
            for i, j in zip(*(x.tolist() for x in _near_pairs(g, least, percent, g["band"][0].as_py())), strict=True):
                if find(i) == find(j):
                    continue
                for x in (i, j):
                    if x not in sets:
                        sets[x] = shingle_set(g["text"][x].as_py(), words, shingle)
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    top[find(i)] = find(j)
                    out.append((i, j))
            if out:
                node = g["node"].to_numpy()
                i, j = (np.array(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["a", "b"])

    return run


def _like_sets(percent: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, mine = _WordHashes(), None, np.empty(0, np.uint64)
        for batch in batches:
            a, b, ok = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i in range(batch.num_rows):
                x, y = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                if x is not last and x != last:  # a centre's pairs stand together
                    last, mine = x, shingle_set(x, words, shingle)
                other = shingle_set(y, words, shingle)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                ok.append(both > 0 and 100 * both >= percent * (len(mine) + len(other) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _rows(
    docs: DataFrame,
    scratch: Scratch,
    percent: int,
    id_col: str,
    text_col: str,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = 20,
) -> DataFrame:
    """One row per row of ``docs``: node (its id), th (its text's hash), n_shingles, low and low_th: those of its component's first row."""
    # th: an id and its text's hash find the text again
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("node"), F.col(f"`{text_col}`").alias("text"))
    src = src.withColumn("th", F.xxhash64("text"))
    sketches = spread(src).mapInArrow(_sketcher(shingle, bands, rows, seed), "node long, th long, n_shingles long, hi long, lo long, sig binary, bands array<long>")
    sketches = scratch.keep(sketches.withColumn("row", F.monotonically_increasing_id()))

    # texts with the same set are one class; the row with the smallest id, then text hash, stands for it
    classes = sketches.where("n_shingles > 0 and node is not null").groupBy("hi", "lo").agg(F.min(F.struct("node", "th", "row")).alias("rep"), F.max("n_shingles").alias("n"))
    classes = scratch.keep(classes.select("hi", "lo", F.col("rep.node").alias("id"), F.col("rep.th").alias("th"), F.col("rep.row").alias("node"), "n"))
    # from here on a node is a class, by the row that stands for it
    held = scratch.keep(sketches.select(F.col("row").alias("node"), "sig", "bands").join(classes.select("node", "n"), "node"))
    keys = held.select(F.posexplode("bands").alias("band", "key"), "node", "n")
    # kept before they are joined back: then both sides are dealt anew, and a hot bucket can be split
    sizes = scratch.keep(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    shared = scratch.keep(keys.join(sizes, "key"))
    popular = shared.groupBy("node").agg(F.sum("size").alias("pop"))
    buckets = scratch.keep(shared.join(popular, "node").select("band", "key", "node", "n", "pop"))

    least = percent / 100 - SIGMAS * (percent / 100 * (1 - percent / 100) / (bands * rows)) ** 0.5

    def texts_of(nodes: DataFrame) -> DataFrame:
        """A text for each node; most others aren't shuffled."""
        named = scratch.keep(nodes.distinct().join(classes.select("node", "id", "th"), "node"))
        of_ids = likely_in(src.where("text is not null").withColumnRenamed("node", "id"), "id", named.select("id"))
        return of_ids.join(named, ["id", "th"]).dropDuplicates(["node"]).select("node", "text")

    sig = held.select("node", "sig", "bands")

    # each bucket's centre with its other members
    top = buckets.groupBy("key").agg(F.max(F.struct("pop", (-F.col("node")).alias("node"), "n")).alias("top"))
    centre = scratch.keep(top.select("key", (-F.col("top.node")).alias("a"), F.col("top.n").alias("an")))
    pairs = buckets.join(centre, "key").where(f"node <> a and 100 * least(n, an) >= {percent} * greatest(n, an)").select("a", F.col("node").alias("b"))
    pairs = scratch.keep(pairs.distinct())
    x = pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b")
    likely = scratch.keep(x.select("a", "b", "x", "y").mapInArrow(_like_signatures(least), "a long, b long"))
    ends = scratch.keep(texts_of(likely.select(F.explode(F.array("a", "b")).alias("node"))))
    y = likely.join(ends.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(ends.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    edges = [scratch.keep(y.select("a", "b", "x", "y").mapInArrow(_like_sets(percent, shingle), "a long, b long"))]
    scratch.drop(pairs, likely, ends)
    comps = connected_components(edges[0], scratch)

    # what isn't one component yet, in blocks
    at = buckets.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    at = scratch.keep(at.select("band", "key", "node", "n", "comp"))
    own = centre.select("key", "a").join(comps.select(F.col("node").alias("a"), "comp"), "a", "left").select("key", "a", F.coalesce("comp", "a").alias("ac"))
    inner = Scratch(scratch.spark, "meetings")
    met = _meetings(at, own, inner)
    met = met.join(sig, "node").select(*_MET).repartition("band", "key", "p", "q").sortWithinPartitions("band", "key", "p", "q", "side", "node")
    kind = "band int, key long, p int, q int, side int, node long, n long, comp long, mask long, sig binary, bands array<long>"
    maybe = scratch.keep(met.mapInArrow(_block_likely(least, percent), kind))
    inner.clear()
    ends = scratch.keep(texts_of(maybe.select("node")))
    full = maybe.join(ends, "node").select(*_MET, "text").repartition("band", "key", "p", "q").sortWithinPartitions("band", "key", "p", "q", "side", "node")
    edges.append(scratch.keep(full.mapInArrow(_block_links(least, percent, shingle), "a long, b long")))
    first = comps
    comps = connected_components(edges[0].union(edges[1]), scratch)
    scratch.drop(first, sizes, shared, centre, buckets, held, at, maybe, ends, *edges)

    # the first row of a component, which may hold most classes: salted
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("s")
    linked = scratch.keep(comps.join(classes.select("node", "id", "th"), "node").withColumn("s", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")))
    low = linked.groupBy("comp").agg(F.min(F.struct("id", "th")).alias("low")).select("comp", F.col("low.id").alias("low"), F.col("low.th").alias("low_th"), salts)
    named = linked.join(low, ["comp", "s"]).select("node", "low", "low_th")
    named = classes.join(named, "node", "left").select("hi", "lo", F.coalesce("low", "id").alias("low"), F.coalesce("low_th", "th").alias("low_th"))
    out = sketches.select("node", "th", "n_shingles", "hi", "lo").join(scratch.keep(named), ["hi", "lo"], "left")
    none = F.col("node").isNull() | (F.col("n_shingles") == 0)
    return out.select("node", "th", "n_shingles", F.when(none, F.col("node")).otherwise(F.col("low")).alias("low"), F.when(none, F.col("th")).otherwise(F.col("low_th")).alias("low_th"))


def minhash_components(docs: DataFrame, scratch: Scratch, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two rows link if their shingle sets' Jaccard similarity is ``percent``
    hundredths or more, confirmed on the full sets. component_id is the
    smallest id of a row reachable by links; kept is true where it is the id
    itself.

    Null and empty texts, and texts of white space, have no shingles and link
    with nothing. Ids are integers. Rows may repeat an id: with equal texts they
    link, with others each goes its own way; the order of rows plays no part.
    Rows with a null id aren't linked and have null component_id and kept. Texts
    may be of any length. Other columns aren't read, whatever their names. An
    empty table gives an empty one.
    """
    out = _rows(docs, scratch, percent, id_col, text_col, **how)
    return out.select(F.col("node").alias("doc_id"), "n_shingles", F.col("low").alias("component_id"), (F.col("node") == F.col("low")).alias("kept"))


def minhash_dedup(docs: DataFrame, scratch: Scratch, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest doc_id stays, and of its texts there the first by hash.

    So each distinct text of a repeated id stays, unless it has a near copy that
    does; equal rows are one. Rows with a null doc_id all stay, as do null and
    empty texts, one of an id.
    """
    kept = _rows(docs, scratch, percent, "doc_id", "text").where("node = low and th = low_th").select("node", "th").distinct()
    rows = docs.select(packed(docs).alias("row"), F.col("doc_id").cast("long").alias("node"), F.xxhash64("text").alias("th"))
    some = rows.where("node is not null").join(kept, ["node", "th"], "left_semi").dropDuplicates(["node", "th"])
    return some.select("row").union(rows.where("node is null").select("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(table(spark, sf_dir, "documents"), Scratch(spark, "minhash"), percent=85)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+4], ' ') END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), cnt AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS h FROM sh GROUP BY doc_id),
rep AS (SELECT h, min(doc_id) AS r FROM sets GROUP BY h),
rs AS (SELECT sh.doc_id, sh.s FROM sh JOIN rep ON sh.doc_id = rep.r),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM rs a JOIN rs b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN cnt a ON a.doc_id = x JOIN cnt b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (
  SELECT r AS x, r AS y FROM rep
  UNION
  SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(cnt.n, 0)::BIGINT AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id, coalesce(comp.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN cnt USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN rep USING (h) LEFT JOIN comp ON comp.x = rep.r
"""
