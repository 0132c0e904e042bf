"""Language-model scoring: prediction by partial matching over bytes.

A trie of byte contexts up to ORDER is counted over all training documents.
A symbol is predicted from the longest context seen; if that context has not
had it, the model escapes to the next shorter one (escape method C: as many
escapes as distinct symbols), where symbols of the longer context are excluded.
The last resort is uniform. Texts end with a symbol of their own, so a text's
log10 probability, the negative of its code length, is one of a distribution
over texts.

Counting is a distributed aggregation, and so are probabilities of the grams
that the trie has at full order. The most frequent of them, a bounded number,
are broadcast; one pass over the documents sums theirs up and keeps aside the
few grams that are rarer or that no training document has. These are looked up
by joins, and unseen ones escape through joins with the shorter contexts. Word
counts go the same two ways. So the corpus is read twice whatever its size, once
to count and once to score, and what goes through the driver doesn't grow.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, spread, table

#: Bytes of context; a trie key holds these and the symbol.
ORDER = 5
#: The end of a text, and what stands before its start; UTF-8 has no such byte.
END = 0xFF
#: Broadcast entries of the trie and of the words at most: about 26 and 12 bytes each.
MAX_TRIE, MAX_WORDS = 1_000_000, 1_000_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_STEP = 1 << 20
_NONE = np.uint64(2**64 - 1)
_END_WORD = b"\n"


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - 2**63


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower() if text else b""  # bytes.lower() lowers A-Z only


def _windows(raw: bytes) -> np.ndarray:
    """Keys of ORDER bytes and a symbol, one for each symbol after the first ORDER bytes of ``raw``."""
    b = np.frombuffer(raw, np.uint8)
    n = len(b) - ORDER
    g = np.zeros(n, np.uint64)
    for k in range(ORDER + 1):
        g <<= np.uint64(8)
        g |= b[k : n + k]
    return g


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """(keys, their texts' numbers, words, their texts' numbers), about _STEP bytes a time; long texts come in pieces."""
    keys: list[bytes] = []
    key_of: list[int] = []
    toks: list[bytes] = []
    tok_of: list[tuple[int, int]] = []
    size = 0

    def flush():
        raw = b"".join(keys)
        lens = np.array([len(k) for k in keys])
        last = np.ones(len(raw), bool)  # may a byte be a window's symbol?
        at = np.concatenate(([0], np.cumsum(lens)[:-1]))
        last[(at[:, None] + np.arange(ORDER)).ravel()] = False
        g = _windows(raw)[last[ORDER:]]
        return g, np.repeat(key_of, lens - ORDER), toks, np.repeat([i for i, _ in tok_of], [n for _, n in tok_of])

    for i, text in enumerate(texts):
        padded = bytes([END]) * ORDER + text + bytes([END])
        a = 0
        while a + ORDER < len(padded):
            keys.append(padded[a : a + ORDER + _STEP])
            key_of.append(i)
            size += len(keys[-1])
            a += _STEP
            if size >= _STEP:
                yield flush()
                keys, key_of, toks, tok_of, size = [], [], [], [], 0
        a = 0
        while a < len(text):
            m = _SPACE.search(text, a + _STEP)
            z = m.start() if m else len(text)
            t = text[a:z].split()
            toks += t
            tok_of.append((i, len(t)))
            a = z
            if z < len(text) and keys == [] and len(toks) > _STEP // 4:
                yield np.empty(0, np.uint64), np.empty(0, np.int64), toks, np.repeat([j for j, _ in tok_of], [n for _, n in tok_of])
                toks, tok_of = [], []
        toks.append(_END_WORD)
        tok_of.append((i, 1))
    if keys:
        yield flush()
    elif toks:
        yield np.empty(0, np.uint64), np.empty(0, np.int64), toks, np.repeat([j for j, _ in tok_of], [n for _, n in tok_of])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of n by sorted distinct key."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(n, at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to partial counts (kind, key, n): kind 0 trie keys, 1 words."""

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(keys), 200_000):
            k = keys[a : a + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n[a : a + 200_000])], names=["kind", "key", "n"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    fresh = 0
    seen: Counter = Counter()

    def word_rows() -> Iterator[pa.RecordBatch]:
        yield from rows(1, np.fromiter(map(_hash, seen), np.int64, len(seen)), np.fromiter(seen.values(), np.int64, len(seen)))

    for batch in batches:
        for g, _, toks, _ in _chunks([_bytes(t.as_py()) for t in batch.column(0)]):
            seen.update(toks)
            if len(seen) > 250_000:
                yield from word_rows()
                seen.clear()
            if len(g):
                held.append(np.unique(g, return_counts=True))
                fresh += len(held[-1][0])
            if fresh > 1_500_000:
                held = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                fresh = 0
                if len(held[0][0]) > 1_500_000:
                    yield from rows(0, *held.pop())
    yield from word_rows()
    if held:
        yield from rows(0, *_summed(*(np.concatenate(x) for x in zip(*held, strict=True))))


def _find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of q stands in sorted keys, and whether it does."""
    if not len(keys):
        return np.zeros(len(q), np.int64), np.zeros(len(q), bool)
    at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
    return at, keys[at] == q


def _slots(q: np.ndarray, size: int) -> np.ndarray:
    return (((q * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


class Grams:
    """A hash table of full-order grams and their log10 probabilities."""

    def __init__(self, k: np.ndarray, v: np.ndarray):
        size = int(1.6 * len(k)) + 8
        self.keys, self.values = np.full(size, _NONE), np.zeros(size)
        todo, slot = np.arange(len(k)), _slots(k, size)
        while len(todo):
            free = self.keys[slot] == _NONE
            at, who = np.unique(slot[free], return_index=True)
            who = np.flatnonzero(free)[who]
            self.keys[at], self.values[at] = k[todo[who]], v[todo[who]]
            left = np.ones(len(todo), bool)
            left[who] = False
            todo, slot = todo[left], (slot[left] + 1) % size

    def look(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each gram's log10 probability, 0 for those that aren't here; and where these stand in q."""
        size = len(self.keys)
        slot = _slots(q, size)
        out = self.values[slot]
        found = self.keys[slot]
        todo = np.flatnonzero(found != q)
        out[todo] = 0
        missing = [todo[found[todo] == _NONE]]
        todo = todo[found[todo] != _NONE]
        while len(todo):
            slot[todo] = (slot[todo] + 1) % size
            k = self.keys[slot[todo]]
            hit = k == q[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            missing.append(todo[k == _NONE])
            todo = todo[~hit & (k != _NONE)]
        return out, np.concatenate(missing)


@dataclass
class Words:
    """Counts of the frequent words, by sorted hash; ``all`` if there are no others."""

    hashes: np.ndarray
    n: np.ndarray
    all: bool

    def count(self, h: np.ndarray) -> np.ndarray:
        """-1 for words that may be elsewhere."""
        at, known = _find(self.hashes, h)
        return np.where(known, self.n[at].astype(np.int64) if len(self.n) else 0, 0 if self.all else -1)


@dataclass
class Frequent:
    grams: Grams
    words: Words
    train_tokens: int
    distinct: int

    def word_value(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.train_tokens + 0.5 * (self.distinct + 1)))


_PART = "n_tokens long, n_known long, base_score double, score double, grams array<long>, words array<long>"


def _lists(of: list[np.ndarray], values: list[np.ndarray], m: int) -> pa.Array:
    """values by their row numbers ``of``, as m lists."""
    rows, v = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (of, values))
    ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=m)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(v[np.argsort(rows, kind="stable")]))


def _scorer(shared):
    """Adds to each row what the frequent grams and words come to, and the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Frequent = shared.value
        memo: dict[bytes, int] = {}
        for batch in batches:
            texts = [_bytes(t.as_py()) for t in batch.column("text")]
            m = len(texts)
            tokens, known, base, score = np.zeros(m, np.int64), np.zeros(m), np.zeros(m), np.zeros(m)
            rare: list[list[np.ndarray]] = [[], [], [], []]
            for g, g_of, toks, tok_of in _chunks(texts):
                if len(g):
                    value, missing = s.grams.look(g)
                    score += np.bincount(g_of, value, m)
                    rare[0].append(g_of[missing])
                    rare[1].append(g[missing].view(np.int64))
                tokens += np.bincount(tok_of, minlength=m)
                if toks:
                    if len(memo) > 150_000:
                        memo.clear()
                    if new := list(set(toks).difference(memo)):
                        memo.update(zip(new, s.words.count(np.fromiter(map(_hash, new), np.int64, len(new))).tolist(), strict=True))
                    c = np.fromiter(map(memo.__getitem__, toks), np.int64, len(toks))
                    here = c >= 0
                    base += np.bincount(tok_of[here], s.word_value(c[here]), m)
                    known += np.bincount(tok_of, c > 0, m)
                    if not here.all():
                        rare[2].append(tok_of[~here])
                        rare[3].append(np.fromiter((_hash(toks[i]) for i in np.flatnonzero(~here)), np.int64))
            columns = [batch.column("row"), pa.array(tokens), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score), _lists(rare[0], rare[1], m), _lists(rare[2], rare[3], m)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_tokens", "n_known", "base_score", "score", "grams", "words"])

    return run


def _low(key: Column, n: int) -> Column:
    """The last n bytes of a gram."""
    return key.bitwiseAND(F.lit((1 << 8 * n) - 1)) if n < 8 else key


def _context(gram: Column) -> Column:
    return F.shiftright(gram, 8)


def _most(counts: DataFrame, most: int) -> int:
    """The least count of a scale (1, 2, 3, 4, 6, 8, 12 and so on) that at most ``most`` of counts.n reach; 1 if all may stay."""
    scale = sorted({x << k for k in range(61) for x in (2, 3)} | {1})
    reach = counts.agg(*[F.count_if(F.col("n") >= n).alias(str(i)) for i, n in enumerate(scale)]).first()
    return next((n for i, n in enumerate(scale) if reach[i] <= most), 2**63 - 1)


@dataclass
class Order:
    """One order of the trie. grams: (k, n); contexts: (x, total, distinct, of_parent), the last the parent's total of the context's symbols."""

    grams: DataFrame
    contexts: DataFrame


def _orders(full: DataFrame, scratch: Scratch) -> list[Order]:
    """All orders from 0, by the counts (k, n) of the highest."""
    grams = [full]
    for j in range(ORDER, 0, -1):
        grams.insert(0, scratch.keep(grams[0].groupBy(_low(F.col("k"), j).alias("k")).agg(F.sum("n").alias("n"))))
    out = []
    for j, g in enumerate(grams):
        # an order's contexts, its symbols with what the parent has of them
        parent = F.lit(1).cast("long")
        both = g.withColumn("parent", parent)
        if j:
            both = g.withColumn("low", _low(F.col("k"), j)).join(grams[j - 1].select(F.col("k").alias("low"), F.col("n").alias("parent")), "low")
        x = both.groupBy(_context(F.col("k")).alias("x")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum("parent").alias("of_parent"))
        out.append(Order(g, scratch.keep(x)))
    return out


def _escaped(unseen: DataFrame, orders: list[Order]) -> DataFrame:
    """(k, p): log10 probabilities of distinct grams that the full order hasn't seen."""
    out, open_ = F.lit(0.0), F.lit(True)
    skip_n, skip_d = F.lit(0).cast("long"), F.lit(0).cast("long")
    now = unseen.select("k", out.alias("p"), open_.alias("open"), skip_n.alias("skip_n"), skip_d.alias("skip_d"))
    for j in range(ORDER, -1, -1):
        contexts, grams = orders[j].contexts, orders[j].grams.select(F.col("k").alias("g"), F.col("n").alias("seen"))
        # up to 65,536 contexts of two bytes, and as many grams of one and a symbol
        contexts, grams = F.broadcast(contexts) if j <= 2 else contexts, F.broadcast(grams) if j <= 1 else grams
        at = now.withColumn("x", _context(_low(F.col("k"), j + 1))).join(contexts, "x", "left").withColumn("g", _low(F.col("k"), j + 1)).join(grams, "g", "left")
        d = F.coalesce(F.col("distinct") - F.col("skip_d"), F.lit(0))
        n = F.col("total") - F.col("skip_n") + d
        go = F.col("open") & (d > 0)
        here = go & F.col("seen").isNotNull()
        p = F.col("p") + F.when(here, F.log10(F.col("seen") / n)).when(go, F.log10(d / n)).otherwise(0.0)
        now = at.select("k", p.alias("p"), (F.col("open") & ~here).alias("open"), F.coalesce("of_parent", "skip_n").alias("skip_n"), F.coalesce("distinct", "skip_d").alias("skip_d"))
    left = F.greatest(256 - F.col("skip_d"), F.lit(1))
    return now.select("k", (F.col("p") - F.when(F.col("open"), F.log10(left)).otherwise(0.0)).alias("p"))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 1, F.lit(False))


def lm_scores(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", max_trie: int = MAX_TRIE, max_words: int = MAX_WORDS) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lowered (A-Z). score is the trie's log10 probability of the text
    and its end, base_score a unigram model's over words and an end. Rows whose
    id hashes to held_out don't train; a null id isn't held out. Null texts are
    empty: they have the end alone. Repeated rows each count. Texts may be of
    any length. Without training rows each byte is as likely as any other. Extra
    columns aren't read; an empty table gives an empty one. The limits change
    what is broadcast, not what comes out.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    src = src.withColumn("held_out", held_out("id"))
    parts = spread(src.where("not held_out").select("text")).mapInArrow(_count, "kind int, key long, n long")
    counts = scratch.keep(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    grams, word_counts = counts.where("kind = 0").select(F.col("key").alias("k"), "n"), counts.where("kind = 1").select("key", "n")
    v, n = word_counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    orders = _orders(grams, scratch)
    x = orders[ORDER].contexts.select("x", "total", "distinct")
    seen = grams.withColumn("x", _context(F.col("k"))).join(x, "x").select("k", "n", F.log10(F.col("n") / (F.col("total") + F.col("distinct"))).alias("p"))
    seen = scratch.keep(seen)

    from_n = _most(seen, max_trie)  # at most max_trie entries through the driver, whatever the corpus
    got = seen.where(F.col("n") >= from_n).select("k", "p").toArrow()
    table_of = Grams(got["k"].to_numpy().view(np.uint64), got["p"].to_numpy())
    from_word = _most(word_counts, max_words)
    got = word_counts.where(F.col("n") >= from_word).toArrow()
    h, c = got["key"].to_numpy(), got["n"].to_numpy()
    del got
    order = np.argsort(h)
    words = Words(h[order], np.minimum(c[order], 2**32 - 1).astype(np.uint32) if len(c) and c.max() < 2**32 else c[order], from_word == 1)
    del h, c, order
    pa.default_memory_pool().release_unused()
    shared = spark.sparkContext.broadcast(Frequent(table_of, words, n, v))
    del table_of, words

    rows = spread(src.select(F.struct("id", "held_out").alias("row"), "text"))
    scored = rows.mapInArrow(_scorer(shared), f"row {rows.schema['row'].dataType.simpleString()}, {_PART}")
    scored = scratch.keep(scored.withColumn("rid", F.monotonically_increasing_id()))
    shared.unpersist()

    rare = scored.select("rid", F.explode("grams").alias("k")).groupBy("rid", "k").agg(F.count(F.lit(1)).alias("times"))
    rare = scratch.keep(rare)
    wanted = rare.select("k").distinct().join(seen.select("k", "p"), "k", "left")
    wanted = scratch.keep(wanted)
    p = wanted.where("p is not null").union(_escaped(wanted.where("p is null").select("k"), orders))
    more = rare.join(scratch.keep(p), "k").groupBy("rid").agg(F.sum(F.col("times") * F.col("p")).alias("more_score"))
    few = scored.select("rid", F.explode("words").alias("key")).groupBy("rid", "key").agg(F.count(F.lit(1)).alias("times"))
    count = F.coalesce(F.col("n"), F.lit(0))
    base = F.log10((count + 0.5) / F.lit(n + 0.5 * (v + 1)))
    few = few.join(word_counts, "key", "left").groupBy("rid").agg(F.sum(F.col("times") * base).alias("more_base"), F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"))
    out = scored.drop("grams", "words").join(more, "rid", "left").join(few, "rid", "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return out.select(F.col("row.id").alias("doc_id"), "row.held_out", "n_tokens", plus("n_known", "more_known"), F.lit(n).cast("long").alias("train_tokens"), plus("base_score", "more_base"), plus("score", "more_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), Scratch(spark, "lm"))


ORACLE = None
