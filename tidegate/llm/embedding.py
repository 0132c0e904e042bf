"""Embedding near-duplicates: random-hyperplane sign hashing in several tables,
exact cosine, connected components.

Vectors meet where all sign bits of one table agree. The number of bits follows
the counted vectors of the largest label, so that strangers meet about once in a
table however many they are; the number of tables follows from the bits and the
wanted recall, growing with the count's power of 0.18. Only keys and ids are
dealt at first; vectors follow to buckets that more than one of them has. Small
buckets are compared many at a time, large ones in blocks of bounded size; what
comes back is a count and one link a vector, never its pairs. A pair that meets
in several tables is counted in the first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, spread, table
from tidegate.llm.components import SALTS, connected_components

#: A pair at the threshold is missed with this probability, closer ones with less.
MISS = 1e-4
LEAST_BITS, MOST_BITS = 8, 30
#: Members of a bucket compared at once; two blocks meet in one group.
BLOCK = 1024
#: Buckets of so few members are compared together.
SMALL = 64
#: So many pairs of two blocks are counted by sums, and not listed.
DENSE = 65536


def tables_for(bits: int, least: float, miss: float = MISS) -> int:
    """So many tables that a pair of cosine ``least`` shares no bucket with probability ``miss``.

    Such vectors agree in a bit with probability 1 - angle / pi: 0.880 at 0.93.
    """
    agree = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(agree**bits, 1 - 1e-12))))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows by the power of two that brings their largest component to [0.5, 1).

    No bit of a component is lost by it, unless it is too small beside the largest
    to count; squares neither overflow nor vanish.
    """
    power = np.frexp(np.abs(x).max(axis=1))[1]
    return np.ldexp(x, -power[:, None])


def _signer(bits: int, tables: int, seed: int):
    """Adds each vector's bytes, as scaled doubles, and its code in every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes.clear()
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, dim)
                x = _scaled(x)
                codes = np.empty((len(x), tables), np.int32)
                for at in range(0, len(x), 1024):
                    signs = (x[at : at + 1024] @ planes[dim] > 0).reshape(-1, tables, bits)
                    codes[at : at + 1024] = (signs * (1 << np.arange(bits, dtype=np.int32))).sum(axis=2)
                raw = pa.array([r.tobytes() for r in x], pa.binary())
                ends = pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32))
                kept = ["row", "label", "dim", "copies"]
                yield pa.RecordBatch.from_arrays([*map(part.column, kept), raw, pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))], names=[*kept, "v", "codes"])

    return run


def _components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n nodes by edges (i, j)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


_GROUP = ["dim", "label", "t", "code", "p", "q"]


def _matrix(col: pa.Array, width: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(len(col), width)


class _Found:
    """Links of one run of rows: counted by row, and joined to the smallest row they reach."""

    def __init__(self, row: np.ndarray, copies: np.ndarray):
        self.row, self.copies = row, copies
        self.links = np.zeros(len(row))
        self.i: list[np.ndarray] = []
        self.j: list[np.ndarray] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        n = len(self.row)
        self.links += np.bincount(i, self.copies[j], n) + np.bincount(j, self.copies[i], n)
        self.i.append(i)
        self.j.append(j)

    def add_dense(self, near: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """The pairs of a matrix, counted by sums; to join them a link a row is enough."""
        self.links[left] += near @ self.copies[right].astype(float)
        self.links[right] += self.copies[left].astype(float) @ near
        nodes = np.concatenate([left, right])
        a, b = np.arange(len(left), dtype=np.int32), np.arange(len(left), len(nodes), dtype=np.int32)
        if left is right:
            b = a
        none = np.int32(len(nodes))
        while True:
            c = np.minimum(a, np.where(near, b[None, :], none).min(axis=1))
            d = np.minimum(c if left is right else b, np.where(near, c[:, None], none).min(axis=0))
            if left is right:
                c = d
            if (c == a).all() and (d == b).all():
                break
            a, b = c, d
        self.i += [left, right]
        self.j += [nodes[a], nodes[b]]

    def batch(self) -> pa.RecordBatch | None:
        if not self.i:
            return None
        low = _components(len(self.row), np.concatenate(self.i), np.concatenate(self.j))
        at = np.flatnonzero(self.links)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (self.row[at], self.links[at].astype(np.int64), self.row[low[at]])], names=["row", "links", "low"])


def _small_pairs(found: _Found, x: np.ndarray, norm: np.ndarray, codes: np.ndarray, t: np.ndarray, at: np.ndarray, group: np.ndarray, least: float) -> None:
    """All pairs of rows ``at`` that stand in one group, at once: neighbours first, then those two apart, and so on."""
    own = group[at]
    for d in range(1, SMALL):
        k = np.flatnonzero(own[d:] == own[: len(own) - d])
        if not len(k):
            return
        i, j = at[k], at[k + d]
        for a in range(0, len(i), 100_000):
            y, z = i[a : a + 100_000], j[a : a + 100_000]
            near = np.einsum("ij,ij->i", x[y], x[z]) / (norm[y] * norm[z]) >= least
            y, z = y[near], z[near]
            if len(y):  # only where no earlier table has brought them together
                earlier = (codes[y] == codes[z]) & (np.arange(codes.shape[1]) < t[y][:, None])
                new = ~earlier.any(axis=1)
                found.add(y[new], z[new])


def _block_pairs(found: _Found, x: np.ndarray, norm: np.ndarray, codes: np.ndarray, t: int, left: np.ndarray, right: np.ndarray, least: float) -> None:
    """Pairs of rows ``left`` and ``right``, which are the same or have none in common."""
    first = codes[left[0], 0]
    if t and (codes[left, 0] == first).all() and (codes[right, 0] == first).all():
        return  # all met in the first table
    near = (x[left] @ x[right].T) / (norm[left][:, None] * norm[right][None, :]) >= least
    if left is right:
        near = np.triu(near, 1)
    for s in range(t):
        n = np.count_nonzero(near)
        if n < DENSE:
            break
        near &= codes[left, s][:, None] != codes[right, s][None, :]
    else:
        s, n = t, np.count_nonzero(near)
    if n >= DENSE:
        found.add_dense(near, left, right)
        return
    i, j = np.nonzero(near)
    y, z = left[i], right[j]
    for a in range(0, len(y), 4096):
        new = ~(codes[y[a : a + 4096], s:t] == codes[z[a : a + 4096], s:t]).any(axis=1)
        if new.any():
            found.add(y[a : a + 4096][new], z[a : a + 4096][new])


def _pair_up(least: float, tables: int):
    """Rows sorted by group, then side, to (row, links, low): links found here, and a row to link to."""

    def whole(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Links of whole groups."""
        dims = rows["dim"].to_numpy()
        for dim in np.unique(dims).tolist():
            part = rows.filter(pa.array(dims == dim)).combine_chunks()
            key = np.stack([part[c].to_numpy().astype(np.int64) for c in _GROUP[1:]], axis=1)
            starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            sizes = np.diff(np.append(starts, len(key)))
            t, side = key[:, 1], part["side"].to_numpy()
            one = key[:, 3] == key[:, 4]
            x = _matrix(part["v"].chunk(0), dim, np.float64)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x))
            codes = part["codes"].chunk(0).flatten().to_numpy().reshape(len(key), tables)
            found = _Found(*(part[c].to_numpy() for c in ("row", "copies")))
            small = (sizes <= SMALL) & one[starts] & (sizes > 1)
            group = np.repeat(np.arange(len(starts)), sizes)
            at = np.flatnonzero(small[group])
            if len(at):
                _small_pairs(found, x, norm, codes, t, at, group, least)
            for g in np.flatnonzero(~small & (sizes > 1)).tolist():
                mine = np.arange(starts[g], starts[g] + sizes[g])
                left = mine if one[mine[0]] else mine[side[mine] == 0]
                right = left if one[mine[0]] else mine[side[mine] == 1]
                if len(left) and len(right):
                    _block_pairs(found, x, norm, codes, int(t[mine[0]]), left, right, least)
            if (b := found.batch()) is not None:
                yield b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            if not rows.num_rows:
                continue
            # the last group may go on in the next batch
            last = np.ones(rows.num_rows, bool)
            for c in _GROUP:
                k = rows[c].to_numpy()
                last &= k == k[-1]
            n = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if n:
                yield from whole(rows.slice(0, n))
            rest = rows.slice(n).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from whole(rest)

    return run


def embedding_links(vectors: DataFrame, scratch: Scratch, least: float = 0.93, block: int = BLOCK, seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal, their lengths too, and their cosine,
    in doubles, is ``least`` or more, however large or small their components are.
    Labels of any type are compared as they
    are. Null vectors, zero vectors, vectors with null or non-finite components,
    and null labels link with nothing. Exact copies are hashed once and count as
    often as they stand. Rows that repeat an id with the same vector are copies
    that link with each other; with different vectors each has links of its own.
    A null id has null component_id and kept. Extra columns aren't read; an
    empty table gives an empty one.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    ok = F.col(f"`{label_col}`").isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(ok, v).alias("v"), F.when(ok, F.col(f"`{label_col}`")).alias("label"))
    good = rows.where("v is not null and vec_id is not null")
    reps = scratch.keep(good.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()))
    most = reps.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits = max(LEAST_BITS, min(MOST_BITS, most.bit_length() + 1))
    tables = tables_for(bits, least)
    # labels by 64 bits, whatever their type
    named = spread(reps.select("row", F.xxhash64("label").alias("label"), "dim", "copies", "v"))
    signed = scratch.keep(named.mapInArrow(_signer(bits, tables, seed), "row long, label long, dim int, copies long, v binary, codes array<int>"))
    at = ["dim", "label", "t", "code"]
    keys = signed.select("row", "label", "dim", F.posexplode("codes").alias("t", "code"))
    sizes = keys.groupBy(*at).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = keys.join(sizes, at).withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    # own block against each block; q = p within one block
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("row", *at, F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    full = met.join(signed.select("row", "copies", "v", "codes"), "row")
    full = full.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "side").select("row", "copies", "v", "codes", *_GROUP, "side")
    found = scratch.keep(full.mapInArrow(_pair_up(least, tables), "row long, links long, low long"))
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select("row", "low"), scratch).withColumnRenamed("node", "row")
    # the smallest id of a component, which may hold most rows: salted
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("s")
    ids = scratch.keep(comps.join(reps.select("row", "node"), "row").withColumn("s", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")))
    low = ids.groupBy("comp").agg(F.min("node").alias("low")).select("comp", "low", salts)
    named = ids.join(low, ["comp", "s"]).select("row", F.col("low").alias("comp"))
    per = reps.select("row", "label", "v", "node", "copies").join(links, "row", "left").join(named, "row", "left")
    per = scratch.keep(per.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("comp", "node").alias("comp")))
    a, b = rows.alias("a"), per.alias("b")
    out = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.v") == F.col("b.v")) & F.col("a.vec_id").isNotNull(), "left")
    comp = F.coalesce("comp", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), (F.col("vec_id") == comp).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"), Scratch(spark, "embedding"))


ORACLE = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c AS component_id, c = vec_id AS kept
FROM embeddings JOIN comp ON comp.x = vec_id LEFT JOIN n ON n.x = vec_id
"""
