"""Benchmark decontamination by a generalised suffix automaton over words.

The automaton of all test items is built once, from word numbers. Documents
stream through it word by word; after each word its state and length tell the
longest stretch ending here that some item holds. A stretch of WINDOW words or
more, or a whole shorter item, is a hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, spread, table

WINDOW = 10
#: Words of items in one automaton (about 0.5 kB a word). Larger benchmarks are
#: dealt to several automata, with a pass over the documents for each.
MAX_WORDS = 200_000
#: Documents with a larger share of hit words are removed whole.
COVERAGE = 0.8

#: ASCII other than digits and letters divides words; A-Z are lowered.
_TO = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO).split() if text else []


class Automaton:
    """Generalised suffix automaton of items, each a list of words."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        numbers: dict[tuple[int, ...], int] = {}
        #: ids by the number of their text: items of equal words share one
        self.ids: list[list[str]] = []
        for i, ws in items:
            if ws:
                seq = tuple(self.vocab.setdefault(w, len(self.vocab)) for w in ws)
                k = numbers.setdefault(seq, len(numbers))
                if k == len(self.ids):
                    self.ids.append([])
                self.ids[k].append(i)
        for seq in numbers:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        n = len(self.len)
        #: state of the last `window` words, for states of that length or more
        self.window_of = [0] * n
        #: shorter texts ending here, [(length, text)]: fewer than ``window``, as each has a length of its own
        self.short: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        self.texts: dict[int, set[int]] = {}
        order = sorted(range(1, n), key=self.len.__getitem__)
        for v in order:
            if self.len[v] >= window:
                u = self.link[v]
                self.window_of[v] = v if self.len[u] < window else self.window_of[u]
        own: dict[int, list[tuple[int, int]]] = {}
        for seq, k in numbers.items():
            v = 0
            for c in seq:
                v = self.next[v][c]
                if self.len[v] >= window:  # an item's own prefix is its state's longest
                    self.texts.setdefault(self.window_of[v], set()).add(k)
            if len(seq) < window:
                own.setdefault(v, []).append((len(seq), k))
        for v in order:
            above = self.short[self.link[v]]
            self.short[v] = own[v] + above if v in own else above
        self.shortest = min([window, *map(len, numbers)])
        self.has_short = bool(own)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link = self.next, self.link
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        self.len.append(self.len[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def matches(self, toks: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches [first, last] in order of last, and the items they are of."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        if len(toks) < self.shortest or not self.vocab:
            return spans, set()
        ids = np.fromiter(map(self.vocab.get, toks, repeat(-1)), np.int64, len(toks))
        known = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        nxt, link, length, window = self.next, self.link, self.len, self.window
        states: set[int] = set()
        for a, b in zip(known[::2], known[1::2], strict=True):  # runs of words that items have
            if b - a < self.shortest:
                continue
            v = n = 0
            for at, c in enumerate(ids[a:b].tolist(), int(a)):
                while v and c not in nxt[v]:
                    v = link[v]
                    n = length[v]
                if c in nxt[v]:
                    v = nxt[v][c]
                    n += 1
                if n >= window and (w := self.window_of[v]) in self.texts:
                    states.add(w)
                    spans.append((at - window + 1, at))
                if self.has_short:
                    longest = 0
                    for m, k in self.short[v]:
                        if m <= n:
                            longest = max(longest, m)
                            found.add(k)
                    if longest:
                        spans.append((at - longest + 1, at))
        for w in states:
            found |= self.texts[w]
        return spans, {i for k in found for i in self.ids[k]}


def covered(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of stretches, as disjoint stretches in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(benchmark: DataFrame, window: int, max_words: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[Automaton]:
    """Automata of at most ``max_words`` words each (one item may be longer), built from a stream of the items."""
    held: list[tuple[str, list[bytes]]] = []
    n = 0
    for i, text in benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(text_col)).toLocalIterator():
        ws = words(text)
        if held and n + len(ws) > max_words:
            yield Automaton(held, window)
            held, n = [], 0
        if ws:
            held.append((i, ws))
            n += len(ws)
    yield Automaton(held, window)


_HITS = "n_words long, spans array<int>, items array<string>"


def _scan(shared):
    """Adds to each row (row, text, spans, items) what one automaton finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = shared.value
        for batch in batches:
            ns, spans, items = [], [], []
            for i, text in enumerate(batch.column("text")):
                toks = words(text.as_py())
                s, f = auto.matches(toks)
                if s:
                    before = batch.column("spans")[i].as_py()
                    s = covered([*zip(before[::2], before[1::2], strict=True), *s])
                    spans.append([x for ab in s for x in ab])
                    items.append(sorted({*batch.column("items")[i].as_py(), *f}))
                else:
                    spans.append(batch.column("spans")[i].as_py())
                    items.append(batch.column("items")[i].as_py())
                ns.append(len(toks))
            keep = [batch.column(c) for c in ("row", "text")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(ns, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], names=["row", "text", "n_words", "spans", "items"])

    return run


def find_hits(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, carry: list[str], window: int = WINDOW, max_words: int = MAX_WORDS, text_col: str = "text") -> DataFrame:
    """row (a struct of ``carry``), text, n_words, spans [first, last, ...] of hit words, items.

    Null and empty texts have no words. Items without words are never found; a
    null item_id is called "null". An empty benchmark finds nothing. Repeated
    rows are scanned each; other columns aren't read.
    """
    spark = docs.sparkSession
    kind = docs.select(F.struct(*carry).alias("row")).schema["row"].dataType.simpleString()
    out = docs.select(F.struct(*carry).alias("row"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.lit([]).cast("array<int>").alias("spans"), F.lit([]).cast("array<string>").alias("items"))
    out = spread(out)
    kept = None
    for k, auto in enumerate(automata(benchmark, window, max_words)):
        if k:
            last, kept = kept, scratch.keep(out)
            out = kept
            if last is not None:
                scratch.drop(last)
        shared = spark.sparkContext.broadcast(auto)
        out = out.select("row", "text", "n_words", "spans", "items").mapInArrow(_scan(shared), f"row {kind}, text string, {_HITS}")
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    at = [m.span() for m in _WORD.finditer(text)]
    parts, done = [], 0
    for a, b in spans:
        parts.append(text[done : at[a][0]])
        done = at[b][1]
    parts.append(text[done:])
    return " ".join(p for p in (x.strip() for x in parts) if p)


def _cut(coverage: float, shared):
    """Texts without their hit stretches, scanned anew until nothing is left to cut."""

    def clean(text: str | None) -> str | None:
        while text:
            toks = words(text)
            spans = covered(shared.value.matches(toks)[0])
            if not spans:
                break
            if sum(b - a + 1 for a, b in spans) > coverage * len(toks):
                return None
            text = _without(text, spans)
        return text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            new = [clean(t) for t in texts]
            gone = [t is not None and n is None for t, n in zip(texts, new, strict=True)]
            arrays = [pa.array(new, pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names).filter(pa.array([not g for g in gone], pa.bool_()))

    return run


def _cut_found(coverage: float):
    """Rows (row, text, n_words, spans) with their spans cut, and whether any was; those covered too far go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, again, stays = [], [], []
            for text, n, flat in zip(*(batch.column(c) for c in ("text", "n_words", "spans")), strict=True):
                text, flat = text.as_py(), flat.as_py()
                spans = [*zip(flat[::2], flat[1::2], strict=True)]
                stays.append(sum(b - a + 1 for a, b in spans) <= coverage * n.as_py())
                again.append(bool(spans))
                texts.append(_without(text, spans) if spans and stays[-1] else text)
            arrays = [batch.column("row"), pa.array(texts, pa.string()), pa.array(again, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "text", "again"]).filter(pa.array(stays, pa.bool_()))

    return run


def _cut_by_rounds(todo: DataFrame, benchmark: DataFrame, scratch: Scratch, coverage: float, window: int, max_words: int) -> DataFrame:
    """What _cut does, with several automata: each round takes the spans of all, then scans anew what was cut."""
    kind = todo.schema["row"].dataType.simpleString()
    done = None
    while True:
        hits = find_hits(todo, benchmark, scratch, ["row"], window, max_words)
        cut = scratch.keep(hits.select("row.row", "text", "n_words", "spans").mapInArrow(_cut_found(coverage), f"row {kind}, text string, again boolean"))
        whole, todo = cut.where("not again").drop("again"), cut.where("again").drop("again")
        done = whole if done is None else done.union(whole)
        if todo.isEmpty():
            return done


def decontaminate(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, coverage: float = COVERAGE, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` with hit stretches cut from ``text``; documents hit on more than ``coverage`` of their words go.

    Rows without hits, null and empty texts among them, stay as they are, with
    all their columns; n_chars, where there is one, follows a cut text.
    """
    out = spread(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    built = [*islice(automata(benchmark, window, max_words), 2)]
    if len(built) == 1:
        out = out.mapInArrow(_cut(coverage, docs.sparkSession.sparkContext.broadcast(built[0])), f"row {out.schema['row'].dataType.simpleString()}, text string")
    else:
        built.clear()
        out = _cut_by_rounds(out, benchmark, scratch, coverage, window, max_words)
    changed = ~F.col("row.text").eqNullSafe(F.col("text"))
    n_chars = lambda c: F.when(changed, F.char_length("text")).otherwise(F.col(f"row.{c}")).cast(docs.schema[c].dataType)
    return out.select(*[F.col("text") if c == "text" else n_chars(c).alias(c) if c == "n_chars" else F.col(f"row.{c}").alias(c) for c in docs.columns])


def report(hits: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.coalesce(F.expr("aggregate(sequence(0, size(spans) div 2), 0L, (s, i) -> s + if(2 * i < size(spans), get(spans, 2 * i + 1) - get(spans, 2 * i) + 1, 0))"), F.lit(0)).cast("long")
    return hits.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "decontam"), ["doc_id"]))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT m FROM win),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)
), hit AS (SELECT doc_id, dw.m, i, item FROM dw JOIN win ON dw.m = win.m AND dw.s = win.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, m, i FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(pos.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
