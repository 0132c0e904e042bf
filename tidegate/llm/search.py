"""Ranked lexical search with a quantised index of two levels.

A document's score for an item is a sum over terms of a weight, which is the
term's, times an impact, which is the term's in the document. The index keeps, for each
document, one byte a term, its impact rounded up; and beside it what the exact
impact is made of. From the bytes alone come bounds of every score. The k-th
highest lower bound of an item is a floor under its k-th score, so only
documents whose upper bound reaches it are scored exactly, all of them, in whole numbers.

The index holds the terms that items ask for. Items come in blocks of bounded
size; a block's terms and weights are broadcast, every document passes by, and a task
keeps k documents an item. So no pair of a document and an item is ever a row
but those k. Everything is scored, however common its terms or many its copies.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.common import Scratch, ascii_lower, spread, table

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: In UTF-8: ASCII digits and letters, the latter lower-cased, and all bytes of other characters; anything else parts terms.
_BYTES = bytes(b if chr(b).isdigit() or b >= 0x80 else b | 0x20 if chr(b).isalpha() else 0x20 for b in range(256))
#: Pairs of an item and a term, and items, that are broadcast at once: some 50 MB.
MAX_PAIRS, MAX_ITEMS = 500_000, 4096
#: Impacts lie below 10**6; a byte is an impact over this, rounded up.
STEP = 3922
#: A text is split into terms by so many bytes at a time; so many sums are worked out at a time.
PIECE, SUMS = 1 << 20, 1 << 20
SALTS = 64


def terms_of(text: bytes) -> Counter:
    """How often each term stands in a text in UTF-8."""
    t, out, at = text.translate(_BYTES), Counter(), 0
    while at < len(t):
        end = t.find(b" ", at + PIECE)
        end = len(t) if end < 0 else end
        out.update(t[at:end].split())
        at = end
    return out


@dataclass
class Block:
    """Items by term: those of term t are items[starts[t]:starts[t + 1]], with how often each holds it."""

    vocabulary: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray
    n_items: int

    @classmethod
    def of(cls, rows: list) -> Block:
        """From rows (item, term, times), whose items are numbered by ``order``."""
        order = {x: i for i, x in enumerate(sorted({r.item for r in rows}))}
        terms = sorted({r.term for r in rows})
        number = {t: i for i, t in enumerate(terms)}
        t = np.array([number[r.term] for r in rows], np.int64)
        at = np.argsort(t, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=len(terms)))])
        items, times = np.array([order[r.item] for r in rows], np.int64)[at], np.array([r.times for r in rows], np.int64)[at]
        return cls({x.encode(): i for x, i in number.items()}, starts, items, times, len(order))


def _forward(df: DataFrame, block, id_col: str, text_col: str) -> DataFrame:
    """One row per row with a term: doc_id, n (its terms, with repeats), terms and tfs (those of the block)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value.vocabulary
        for b in batches:
            ns, terms, tfs = [], [], []
            for x in b.column(1).cast(pa.large_binary()):
                c = terms_of(x.as_py() or b"")
                held = [(known[t], n) for t, n in c.items() if t in known]
                ns.append(c.total())
                terms.append([t for t, _ in held])
                tfs.append([n for _, n in held])
            yield pa.record_batch([b.column(0), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    rows = spread(df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<bigint>").where("n > 0")


def _exact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _indexed(forward: DataFrame, n: int, total: int) -> DataFrame:
    """The index: doc_id, m, terms, tfs, and bytes, the impacts rounded up."""

    def impacts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tfs = b.column("tfs")
            size = np.diff(tfs.offsets.to_numpy())
            q = -(-_exact(tfs.flatten().to_numpy(), np.repeat(b.column("m").to_numpy(), size)) // STEP)
            packed, ends = q.astype(np.uint8).tobytes(), np.cumsum(size)
            yield pa.record_batch([*b.columns, pa.array([packed[e - s : e] for s, e in zip(size, ends, strict=True)], pa.binary())], names=["doc_id", "m", "terms", "tfs", "bytes"])

    # 75 * n * N may pass 64 bits
    m = F.expr(f"25 + cast((cast(75 * n as decimal(38, 0)) * {n}) div {max(total, 1)} as long)").alias("m")
    return forward.select("doc_id", m, "terms", "tfs").mapInArrow(impacts, "doc_id long, m long, terms array<int>, tfs array<bigint>, bytes binary")


def _slices(b: pa.RecordBatch, block: Block, weights: np.ndarray) -> Iterator[tuple]:
    """A batch's documents some at a time, with each of their terms in each of its items.

    (first, docs, posting, doc, item, weight): arrays over such meetings.
    """
    terms = b.column("terms").flatten().to_numpy()
    ends = np.cumsum(np.diff(b.column("terms").offsets.to_numpy()))
    each = block.starts[terms + 1] - block.starts[terms]
    met = np.concatenate([[0], np.cumsum(each)])
    first, n = 0, b.num_rows
    while first < n:
        start = ends[first - 1] if first else 0
        last = int(np.searchsorted(met[ends], met[start] + SUMS, side="right"))
        last = min(n, max(first + 1, min(last, first + max(1, SUMS // block.n_items))))
        at = slice(start, ends[last - 1])
        posting = np.repeat(np.arange(start, ends[last - 1]), each[at])
        pair = np.arange(len(posting)) + np.repeat(block.starts[terms[at]] - (met[start : ends[last - 1]] - met[start]), each[at])
        yield first, last - first, posting, np.searchsorted(ends[first:last], posting, side="right"), block.items[pair], weights[pair]
        first = last


def _bound(part: tuple, each: np.ndarray, n_items: int) -> np.ndarray:
    """Sums of weight times ``each`` (of a posting) by document and item."""
    _, docs, posting, doc, item, weight = part
    return np.bincount(doc * n_items + item, weight * each[posting], minlength=docs * n_items).reshape(docs, n_items)


def _quantised(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("bytes").to_pylist()), np.uint8).astype(np.float64)


def _floors(index: DataFrame, shared, k: int) -> DataFrame:
    """Of each task, the k highest lower bounds of each item: rows (item, floor)."""

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = shared.value
        best = np.zeros((0, block.n_items))
        for b in batches:
            q = _quantised(b)
            least = np.where(q > 0, (q - 1) * STEP + 1, 0)
            for part in _slices(b, block, weights):
                best = np.concatenate([best, _bound(part, least, block.n_items)])
                best = np.partition(best, len(best) - k, axis=0)[-k:] if len(best) > k else best
        # sums beyond 2 ** 53 are rounded: a little less is a floor still
        flat = np.floor(best * (1 - 1e-9)).astype(np.int64).ravel()
        items = np.tile(np.arange(block.n_items), len(best))
        yield pa.record_batch([pa.array(items[flat > 0], pa.int32()), pa.array(flat[flat > 0])], names=["item", "floor"])

    return index.select("terms", "bytes").mapInArrow(lower, "item int, floor long")


def _first_in_item(item: np.ndarray, score: np.ndarray, known: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Rows among the first k of their item: highest score, then smallest id, null before all."""
    order = np.lexsort((doc, known, -score, item))
    i = item[order]
    begin = np.searchsorted(i, i, side="left")
    return order[np.arange(len(i)) - begin < k]


def _rescored(index: DataFrame, shared, k: int) -> DataFrame:
    """Of each task, each item's k best documents by exact score: rows (item, doc_id, score)."""

    def rescore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights, floors = shared.value
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
        for b in batches:
            q, tfs = _quantised(b), b.column("tfs")
            impact = _exact(tfs.flatten().to_numpy(), np.repeat(b.column("m").to_numpy(), np.diff(tfs.offsets.to_numpy())))
            known = np.asarray(b.column("doc_id").is_valid())
            ids = b.column("doc_id").fill_null(0).to_numpy()
            for part in _slices(b, block, weights):
                first, docs, posting, doc, item, weight = part
                upper = np.ceil(_bound(part, q * STEP, block.n_items) * (1 + 1e-9))
                reach = ((upper >= floors) & (upper > 0)).ravel()
                cell = doc * block.n_items + item
                on = reach[cell]
                gain = weight[on] * impact[posting[on]]
                # in halves, as sums of doubles are exact up to 2 ** 53 only
                score = sum(np.bincount(cell[on], half, minlength=docs * block.n_items).astype(np.int64) << shift for half, shift in ((gain & (1 << 26) - 1, 0), (gain >> 26, 26)))
                cells = np.flatnonzero(score)
                d = first + cells // block.n_items
                held = [np.concatenate(x) for x in zip(held, (cells % block.n_items, score[cells], known[d], ids[d]), strict=True)]
                best = _first_in_item(*held, k)
                held = [x[best] for x in held]
        item, score, known, doc = held
        yield pa.record_batch([pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=~known), pa.array(score)], names=["item", "doc_id", "score"])

    return index.select("doc_id", "m", "terms", "tfs", "bytes").mapInArrow(rescore, "item int, doc_id long, score long")


def _best(rows: DataFrame, order: list, k: int) -> DataFrame:
    """The first k rows of each item, with their ``rank``; by parts first, as every task has k."""
    part = rows.withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    own = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return own.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("part")


def _blocks(wanted: DataFrame, most_pairs: int, most_items: int) -> list[DataFrame]:
    """Rows (item, term, times) in parts of at most so many rows and items each, or of one item."""
    items = wanted.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    pairs, n = items.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(-(-pairs // most_pairs), -(-n // most_items))
    at = lambda p: F.pmod(F.xxhash64("item", F.lit(p)), F.lit(p))
    while parts > 1 and not items.groupBy(at(parts)).agg(F.sum("n").alias("p"), F.count(F.lit(1)).alias("i")).where((F.col("i") > most_items) | (F.col("p") > most_pairs) & (F.col("i") > 1)).isEmpty():
        parts *= 2
    return [wanted] if parts == 1 else [wanted.where(at(parts) == p) for p in range(parts)]


def search(docs: DataFrame, items: DataFrame, scratch: Scratch, k: int = 10, most_pairs: int = MAX_PAIRS, most_items: int = MAX_ITEMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each item's k highest-scoring documents: item_id, rank, doc_id, score.

    ``items`` has item_id and text. Ids of documents are integers. Every row is a document, and an item, of its
    own, so repeated rows each take a rank; equal scores go by ascending doc_id,
    null first. Null texts and texts without terms are no documents and find
    nothing. Other columns aren't read; empty tables give an empty one. An item
    of more than ``most_pairs`` different terms is a block by itself. A block
    reads the texts once.
    """
    asked = scratch.keep(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"))
    wanted = scratch.keep(asked.select("item", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")))
    found = [_searched(docs, part, scratch, k, id_col, text_col) for part in _blocks(wanted, most_pairs, most_items)]
    out = scratch.spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for f in found:
        out = out.unionByName(f)
    return out.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _searched(docs: DataFrame, wanted: DataFrame, scratch: Scratch, k: int, id_col: str, text_col: str) -> DataFrame:
    """The documents of a block of items, its terms and weights being broadcast."""
    spark = scratch.spark
    rows = wanted.collect()
    if not rows:
        return spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    block = Block.of(rows)
    shared = spark.sparkContext.broadcast(block)
    forward = scratch.keep(_forward(docs, shared, id_col, text_col))
    shared.destroy()
    n, total = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(block.vocabulary), np.int64)
    for t, c in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[t] = c
    w = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    weights = block.times * np.repeat(w, np.diff(block.starts))
    index = scratch.keep(_indexed(forward, n, total))
    scratch.drop(forward)
    block.vocabulary = {}
    shared = spark.sparkContext.broadcast((block, weights))
    lowest = _best(_floors(index, shared, k), [F.desc("floor")], k).where(F.col("rank") == k).select("item", "floor").collect()
    shared.destroy()
    floors = np.zeros(block.n_items)
    for i, floor in lowest:
        floors[i] = floor
    shared = spark.sparkContext.broadcast((block, weights, floors))
    numbers = sorted({r.item for r in rows})
    names = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "item int, number long")
    best = scratch.keep(_best(_rescored(index, shared, k), [F.desc("score"), F.asc("doc_id")], k).join(names, "item").select(F.col("number").alias("item"), "doc_id", "score", "rank"))
    shared.destroy()
    scratch.drop(index)
    return best


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "search"))


_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, len(ts)::BIGINT AS n, ts FROM d WHERE len(ts) > 0),
s AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM n),
p AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM n) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY t, nn),
b AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS ts FROM benchmark),
q AS (SELECT i, item_id, t, count(*)::BIGINT AS times FROM (SELECT i, item_id, unnest(ts) AS t FROM b) GROUP BY i, item_id, t),
m AS (SELECT r, doc_id, (25 + (75 * n * nn) // l)::BIGINT AS m FROM n, s),
x AS (
  SELECT q.i, q.item_id, m.doc_id, m.r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY q.i, q.item_id, m.doc_id, m.r
), k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
