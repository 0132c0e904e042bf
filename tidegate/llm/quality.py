"""Quality classifier by co-training.

Two views of a document, its text (words and shape) and its page metadata
(language, source, length), have a logistic classifier each, for two targets:
low quality and toxic. Over some rounds each view labels, for the other, those
unlabelled documents of which its calibrated probability is sure. At last the
views' calibrated log-odds are combined, weighed on labelled documents that no
fit has seen, and score every document.

Fitting uses bounded samples of labelled and unlabelled documents (MAX_LABELLED,
MAX_POOL, by hash of doc_id); scoring covers all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.common import Scratch, packed, spread, table
from tidegate.llm.decontam import words

#: Bounds of the samples that the classifiers are fitted on.
MAX_LABELLED, MAX_POOL = 12_000, 4_000
#: The text view knows words and beginnings of longer words that tell a target's
#: documents apart by so many standard errors in the sample; the best first. Words
#: that are toxic are few and rare, while low quality shows in a text's shape.
MAX_WORDS, MIN_DOCS = 30_000, 3
MIN_Z = {"low": 5.0, "toxic": 3.5}
L2 = {"low": 2e-4, "toxic": 2e-5}
#: Documents below both probabilities are kept.
MOST = {"low": 0.5, "toxic": 0.2}
BEGINNINGS = (4, 5, 6, 7, 8, 9, 10)
ROUNDS = 3
#: A view hands on what it is so sure of; at this weight.
SURE, PSEUDO_WEIGHT = 0.95, 0.3
TARGETS = ("low", "toxic")
BINS = 12
#: Rows whose features are held as Python's numbers at once, and words whose features a scorer remembers: bounds on memory, not on results.
SLICE, MEMO = 64, 50_000
_SHAPE = 9
#: Metadata hash to so many features (sources are many).
META = 4096

_UP, _DIGIT, _SPACE, _HIGH = 1, 2, 3, 4
_CLASS = np.array([_UP if 65 <= c <= 90 else _DIGIT if 48 <= c <= 57 else _SPACE if c == 32 or 9 <= c <= 13 else 0 if 97 <= c <= 122 else _HIGH if c >= 128 else 5 for c in range(256)], np.uint8)


def _bin(x: float) -> int:
    """0 to 1 on a scale finer near 0."""
    return min(BINS - 1, int(math.sqrt(max(0.0, x)) * BINS))


def shape(text: str, toks: list[bytes]) -> list[int]:
    """Binned shares of a text: each feature's number, or none for an empty text."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return []
    c = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=6)
    n, k = len(raw), max(len(toks), 1)
    kinds = len(set(toks))
    again = sum(map(bytes.__eq__, toks, toks[1:]))
    values = [c[_UP] / n, c[_DIGIT] / n, c[5] / n, c[_HIGH] / n, raw.count(b"|") / k, again / k, kinds / k, min(1.0, len(raw) / k / 40), min(1.0, math.log2(1 + k) / 20)]
    return [i * BINS + _bin(float(v)) for i, v in enumerate(values)]


def metadata(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    length = int(math.log2(n_chars + 1)) if n_chars is not None and n_chars >= 0 else -1
    return [xxhash.xxh32_intdigest(f"{k}={v}") % META for k, v in (("lang", lang), ("source", source), ("length", length))]


def forms(word: bytes) -> list[int]:
    """Hashes of a word and of its beginnings: words are built from others, also those that the sample lacks."""
    return [xxhash.xxh3_64_intdigest(word) - 2**63, *[xxhash.xxh3_64_intdigest(word[:k] + b"*") - 2**63 for k in BEGINNINGS if k < len(word)]]


def word_hashes(toks: list[bytes]) -> list[int]:
    return list({h for w in set(toks) for h in forms(w)})


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, lang, source, n_chars, low, toxic) to features."""
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        rows = batch.to_pylist()
        toks = [words(r["text"]) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("low"),
                batch.column("toxic"),
                pa.array([shape(r["text"] or "", t) for r, t in zip(rows, toks, strict=True)], pa.list_(pa.int32())),
                pa.array([word_hashes(t) for t in toks], pa.list_(pa.int64())),
                pa.array([metadata(r["lang"], r["source"], r["n_chars"]) for r in rows], pa.list_(pa.int32())),
            ],
            names=["id", "low", "toxic", "shape", "words", "meta"],
        )


@dataclass
class Rows:
    """Sparse rows of binary features."""

    ids: np.ndarray
    lens: np.ndarray
    width: int

    @classmethod
    def of(cls, lists: list[np.ndarray], width: int) -> Rows:
        return cls(np.concatenate([*lists, np.empty(0, np.int64)]).astype(np.int64), np.array([len(x) for x in lists], np.int64), width)

    def only(self, used: np.ndarray) -> Rows:
        """Without the features that aren't used."""
        keep = used[self.ids]
        of = np.repeat(np.arange(len(self.lens)), self.lens)[keep]
        return Rows(self.ids[keep], np.bincount(of, minlength=len(self.lens)).astype(np.int64), len(used))

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.bincount(np.repeat(np.arange(len(self.lens)), self.lens), w[self.ids], len(self.lens))
        return out.astype(float)

    def pull(self, e: np.ndarray) -> np.ndarray:
        return np.bincount(self.ids, np.repeat(e, self.lens), self.width)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Rows, y: np.ndarray, weight: np.ndarray, start: tuple[np.ndarray, float] | None = None, steps: int = 150, l2: float = 2e-5, rate: float = 0.15) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam on the whole sample, from ``start``."""
    w, b = (start[0].copy(), start[1]) if start else (np.zeros(x.width), 0.0)
    total = weight.sum()
    if not total:
        return w, b
    m, v = np.zeros(x.width + 1), np.zeros(x.width + 1)
    for t in range(1, steps + 1):
        e = (_sigmoid(x.dot(w) + b) - y) * weight / total
        g = np.append(x.pull(e) + l2 * w, e.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    return w, b


def calibrate(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Platt's (bias, slopes) for log-odds z, one column a view, by Newton with a weak prior of slope 0."""
    z = np.clip(z, -15, 15)
    x = np.column_stack([np.ones(len(z)), z])
    c = np.zeros(x.shape[1])
    pos = y.sum()
    soft = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
    prior = np.diag([1e-6, *[0.05] * (x.shape[1] - 1)])
    for _ in range(50):
        p = _sigmoid(x @ c)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + prior + 1e-9 * np.eye(len(c)), x.T @ (p - soft) + prior @ c)
        c -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    return c


@dataclass
class Model:
    vocab: dict[int, int]
    #: by target: (text weights, bias), (metadata weights, bias), combination (bias, slopes)
    text: dict[str, tuple[np.ndarray, float]] = field(default_factory=dict)
    meta: dict[str, tuple[np.ndarray, float]] = field(default_factory=dict)
    both: dict[str, np.ndarray] = field(default_factory=dict)


@dataclass
class Sample:
    """Rows of both samples: text and metadata features, targets (nan unknown), and which are of the pool."""

    text: Rows
    meta: Rows
    targets: dict[str, np.ndarray]
    pool: np.ndarray
    held: np.ndarray

    @classmethod
    def of(cls, t: pa.Table) -> Sample:
        def lists(c: str) -> tuple[np.ndarray, np.ndarray]:
            a = t[c].combine_chunks()
            return a.flatten().to_numpy(zero_copy_only=False).astype(np.int64), a.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

        (shape_ids, shape_n), (word_ids, word_n), (meta_ids, meta_n) = lists("shape"), lists("words"), lists("meta")
        n, base = t.num_rows, _SHAPE * BINS
        of_row = np.concatenate([np.repeat(np.arange(n), shape_n), np.repeat(np.arange(n), word_n)])
        ids = np.concatenate([shape_ids, word_ids + base])[np.argsort(of_row, kind="stable")]
        width = base + (int(word_ids.max()) + 1 if len(word_ids) else 0)
        targets = {x: t[x].cast(pa.float64()).to_numpy(zero_copy_only=False) for x in TARGETS}
        return cls(Rows(ids, shape_n + word_n, width), Rows(meta_ids, meta_n, META), targets, *(t[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("free", "held")))


def co_train(vocab: dict[int, int], sample: Sample, tells: dict[str, np.ndarray], rounds: int = ROUNDS) -> Model:
    """Fits both views of both targets, each target with the words that tell it. Held rows, a fifth, calibrate only."""
    model = Model(vocab)
    width, n = _SHAPE * BINS + len(vocab), len(sample.pool)
    for target in TARGETS:
        used = np.concatenate([np.ones(_SHAPE * BINS, bool), tells[target]])
        views = [sample.text.only(used), sample.meta]
        truth = np.nan_to_num(sample.targets[target])
        known = ~np.isnan(sample.targets[target]) & ~sample.pool
        held = known & sample.held
        fitted = truth[known & ~held]
        if not len(fitted) or fitted.min() == fitted.max():  # nothing to tell apart
            flat = bool(len(fitted) and fitted[0])
            model.text[target], model.meta[target] = (np.zeros(width), 0.0), (np.zeros(META), 0.0)
            model.both[target] = np.array([4.0 if flat else -4.0, 0.0, 0.0])
            continue
        y = [truth.copy(), truth.copy()]
        weight = [(known & ~held).astype(float) for _ in views]
        fits: list = [None, None]
        for r in range(rounds):
            sure = []
            for k, x in enumerate(views):
                fits[k] = fit(x, y[k], weight[k], fits[k], steps=150 if r == 0 else 40, l2=L2[target])
                z = x.dot(fits[k][0]) + fits[k][1]
                at = held if held.any() else known
                c = calibrate(z[at, None], truth[at])
                p = _sigmoid(c[0] + c[1] * np.clip(z, -15, 15))
                sure.append(p)
            for k, p in enumerate(sure):  # each view teaches the other
                free = ~known
                for value, at in ((1.0, free & (p >= SURE)), (0.0, free & (p <= 1 - SURE))):
                    y[1 - k][at] = value
                    weight[1 - k][at] = PSEUDO_WEIGHT
        for k, x in enumerate(views):
            fits[k] = fit(x, y[k], weight[k], fits[k], steps=40, l2=L2[target])
        z = np.column_stack([x.dot(f[0]) + f[1] for x, f in zip(views, fits, strict=True)])
        at = held if held.any() else known
        model.text[target], model.meta[target] = fits
        model.both[target] = calibrate(z[at], truth[at])
    return model


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL) -> Model:
    """The model of the labelled and unlabelled samples. Labels: doc_id, quality, toxic, nulls unknown; of repeated ids the worst holds."""
    src = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    of = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg((1 - F.min("quality")).cast("int").alias("low"), F.max("toxic").cast("int").alias("toxic"))
    # the labelled ids that docs still has; a sample by hash is the same in every run
    ids = src.select("id").where("id is not null").distinct()
    lab = scratch.keep(of.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    free = ids.join(of, "id", "left_anti").orderBy(F.xxhash64("id"), "id").limit(max_pool)
    pool = scratch.keep(free.select("id", F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("toxic")))
    want = lab.withColumn("pool", F.lit(False)).union(pool.withColumn("pool", F.lit(True)))
    # of rows that repeat an id the same one in every run
    one_each = Window.partitionBy("id").orderBy(F.xxhash64("text", "lang", "source", "n_chars"), "text")
    # at most max_labelled + max_pool rows of three numbers
    feats = scratch.keep(
        src.join(F.broadcast(want.select("id", "low", "toxic")), "id").withColumn("nth", F.row_number().over(one_each)).where("nth = 1").select("id", "text", "lang", "source", "n_chars", "low", "toxic")
        .mapInArrow(_features, "id long, low int, toxic int, shape array<int>, words array<long>, meta array<int>")
    )
    feats = scratch.keep(feats.withColumn("held", F.pmod(F.xxhash64(F.lit("held"), "id"), F.lit(5)) == 0))
    fitted = feats.where("not held")
    size = fitted.agg(*[f(F.lit(1) if t is None else F.col(t)).alias(n) for t, f, n in ((None, F.count, "n"), ("low", F.count, "low_n"), ("low", F.sum, "low_1"), ("toxic", F.count, "toxic_n"), ("toxic", F.sum, "toxic_1"))]).first()
    per = fitted.select("low", "toxic", F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"), *[f(t).alias(f"{t}_{k}") for t in TARGETS for f, k in ((F.count, "n"), (F.sum, "1"))]).where(f"n >= {MIN_DOCS}")

    def z(t: str) -> Column:
        """How far a word's shares of both classes lie apart, in standard errors."""
        n, one = size[f"{t}_n"] or 0, size[f"{t}_1"] or 0
        if not 0 < one < n:
            return F.lit(0.0)
        p = F.col(f"{t}_n") / n
        return F.abs(F.col(f"{t}_1") / one - (F.col(f"{t}_n") - F.col(f"{t}_1")) / (n - one)) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / one + 1 / (n - one)))

    told = per.select("w", *[(z(t) / MIN_Z[t]).alias(t) for t in TARGETS])
    top = told.where("low >= 1 or toxic >= 1").orderBy(F.greatest(*TARGETS).desc(), "w").limit(MAX_WORDS).toArrow()
    known = top["w"].to_pylist()
    tells = {t: top[t].to_numpy() >= 1 for t in TARGETS}
    vocab = {w: i for i, w in enumerate(known)}
    numbers = scratch.spark.createDataFrame(pa.table({"w": pa.array(known, pa.int64()), "i": pa.array(range(len(known)), pa.int32())}))
    kept = feats.select("id", F.explode("words").alias("w")).join(numbers, "w").groupBy("id").agg(F.collect_list("i").alias("words"))
    rows = feats.drop("words").join(kept, "id", "left").join(pool.select("id", F.lit(True).alias("free")), "id", "left")
    rows = rows.select("held", "low", "toxic", "shape", "meta", F.coalesce("words", F.lit([]).cast("array<int>")).alias("words"), F.coalesce("free", F.lit(False)).alias("free"), F.xxhash64("id").alias("at"), "id")
    have = rows.toArrow().sort_by([("at", "ascending"), ("id", "ascending")]).combine_chunks()
    model = co_train(vocab, Sample.of(have), tells)
    scratch.drop(lab, pool)
    return model


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        known = {t: (model.text[t][0], model.meta[t][0]) for t in TARGETS}
        # words as bytes are met far more often than they are new
        memo: dict[bytes, tuple[int, ...]] = {}
        base = _SHAPE * BINS
        for batch in batches:
            out: dict[str, list[float]] = {f"{v}_{t}": [] for t in TARGETS for v in ("text", "meta", "p")}
            cols = [batch.column(c) for c in ("text", "lang", "source", "n_chars")]
            for i in range(batch.num_rows):
                text, lang, source, n_chars = (c[i].as_py() for c in cols)
                toks = words(text)
                ids, mine = shape(text or "", toks), set()
                for w in set(toks):
                    k = memo.get(w)
                    if k is None:
                        if len(memo) > MEMO:
                            memo.clear()
                        k = memo[w] = tuple(base + i for i in map(model.vocab.get, forms(w)) if i is not None)
                    if k:
                        mine.update(k)
                ids += mine
                meta = metadata(lang, source, n_chars)
                for t in TARGETS:
                    a = float(known[t][0][ids].sum() + model.text[t][1]) if ids else model.text[t][1]
                    b = float(known[t][1][meta].sum() + model.meta[t][1])
                    c = model.both[t]
                    z = float(c[0] + c[1] * min(15, max(-15, a)) + c[2] * min(15, max(-15, b)))
                    out[f"text_{t}"].append(a)
                    out[f"meta_{t}"].append(b)
                    out[f"p_{t}"].append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(v, pa.float64()) for v in out.values()]], names=["row", *out])

    return run


def score(docs: DataFrame, model: Model, row: Column) -> DataFrame:
    """``row`` with text_, meta_ (log-odds) and p_ (probability) of low and toxic; all rows of docs.

    Null and empty texts have no text features and are judged by the rest.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_WORDS weights a target
    src = docs.select(row.alias("row"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    kind = src.schema["row"].dataType.simpleString()
    return spread(src).mapInArrow(_scorer(shared), f"row {kind}, " + ", ".join(f"{v}_{t} double" for t in TARGETS for v in ("text", "meta", "p")))


KEPT = f"p_low < {MOST['low']} and p_toxic < {MOST['toxic']}"


def accepted(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` without the rows judged low or toxic, all columns as they were.

    Rows that repeat an id are judged each by its own text. Without labels, and
    where all have one value, no row is refused. An empty table gives an empty one.
    """
    return score(docs, train(docs, labels, scratch), packed(docs)).where(KEPT).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), Scratch(spark, "quality"))
    out = score(docs, model, F.struct("doc_id"))
    return out.select("row.doc_id", (1 - F.col("p_low")).alias("quality"), F.col("p_toxic").alias("toxic"), "text_low", "meta_low", "text_toxic", "meta_toxic", F.expr(KEPT).alias("kept"))


ORACLE = None
