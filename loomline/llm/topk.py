"""Exact top-k by integer inner product: a Voronoi join.

Every vector goes to its nearest pivot. For a group with pivot p and radius r,
<q, x> <= <q, p> + |q| r for all of its members x, so a group is needed by a
query only if that bound reaches the query's k-th best score over a fixed seed
sample (real candidates, so a true lower bound). Pivots and seeds are the rows
of smallest hash, `n_seeds` of them at every size and pivots by the root of the number
of rows, 64 to 1,024; the summary is one row per pivot. The queries, the smaller side, are what is replicated to the
groups that need them. Groups are cut into chunks of about `chunk_rows` rows and
queries into blocks, so neither a group of equal vectors nor many queries land
in one task; a chunk is sent to the blocks with a query that needs its group, and to no other.
Every (chunk, block) keeps its own k best and a window merges them.

Defined results: vectors that are null or hold a null or non-finite component,
and rows with a null id, take no part; a repeated row is a candidate each time and
asks once; candidates with the query's id are its own; shorter vectors count as padded with zeros; ties go
to the smaller id; scores beyond a long are clipped to it; an empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, materialize

LONG = 2**63 - 1


def _vectors(column: pa.Array) -> list:
    """A float64 array of floor(256 x) for each row, or None."""
    out = []
    for x in column:
        v = x.values if x.is_valid else None
        if v is None or v.null_count:
            out.append(None)
            continue
        a = np.floor(256.0 * v.to_numpy(zero_copy_only=False).astype(np.float64))
        out.append(a if np.isfinite(a).all() else None)
    return out


def _quantized(batches):
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.binary())])
    for b in batches:
        rows = [(i.as_py(), v.tobytes()) for i, v in zip(b["vec_id"], _vectors(b["v"]), strict=True) if v is not None and i.is_valid]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=schema)


def _matrix(blobs, width: int = 0) -> np.ndarray:
    """Rows of vectors, padded with zeros to the widest (width at least)."""
    arrays = [np.frombuffer(b) for b in blobs]
    width = max([width, *(len(a) for a in arrays)])
    if all(len(a) == width for a in arrays):
        return np.frombuffer(b"".join(blobs)).reshape(len(arrays), width)
    out = np.zeros((len(arrays), width))
    for k, a in enumerate(arrays):
        out[k, : len(a)] = a
    return out


def _fit(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64: by float64 where every partial sum is below 2^53, else by Python integers."""
    width = max(q.shape[1], x.shape[1])
    q, x = _fit(q, width), _fit(x, width)
    if width == 0:
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width < 2**53:
        return (q @ x.T).astype(np.int64)
    whole = lambda a: np.array([[int(c) for c in row] for row in a], dtype=object).reshape(a.shape)
    return np.clip(whole(q).dot(whole(x).T), -LONG - 1, LONG).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """A mask of each row's k best; of equal scores the leftmost."""
    n = scores.shape[1]
    if n <= k:
        return np.ones(scores.shape, bool)
    kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
    over, level = scores > kth, scores == kth
    return over | (level & (np.cumsum(level, axis=1) <= k - over.sum(axis=1, keepdims=True)))


def top_k(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 50, k: int = 5, n_pivots: int | None = None, n_seeds: int = 1024, chunk_rows: int = 4096, block_queries: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows whose id is divisible by `every`, their k best others."""
    slim = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    data = materialize(slim.mapInArrow(_quantized, "vec_id long, v binary"), "vectors")
    n_pivots = n_pivots or min(1024, max(64, int(data.count() ** 0.5) // 4))
    seeds = data.dropDuplicates(["vec_id", "v"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_seeds).toPandas()
    seed_ids, seed_v = seeds["vec_id"].to_numpy(), _matrix(list(seeds["v"]))
    pivots = seed_v[:n_pivots]

    def assign(batches):
        schema = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("g", pa.int32()), ("r", pa.float64())])
        for b in batches:
            x = _matrix(b["v"].to_pylist(), pivots.shape[1])
            p = _fit(pivots, x.shape[1])
            d = (x * x).sum(1)[:, None] - 2 * (x @ p.T) + (p * p).sum(1)
            g = d.argmin(1)
            r = np.sqrt(((x - p[g]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b["vec_id"].cast(pa.int64()), b["v"].cast(pa.binary()), pa.array(g, pa.int32()), pa.array(r)], schema=schema)

    grouped = materialize(data.mapInArrow(assign, "vec_id long, v binary, g int, r double"), "vector-groups")
    # At most n_pivots rows.
    summary = grouped.groupBy("g").agg(F.count("*").alias("n"), F.max("r").alias("r")).toPandas().sort_values("g")
    groups = summary["g"].to_numpy()
    radius, chunks = summary["r"].to_numpy() * (1 + 1e-9) + 1e-6, np.maximum(1, -(-summary["n"].to_numpy() // chunk_rows))
    centers = pivots[groups] if len(groups) else pivots[:0]
    n_chunks = F.create_map(*[F.lit(int(x)) for pair in zip(groups, chunks, strict=True) for x in pair]) if len(groups) else None

    def place(batches):
        schema = pa.schema([("g", pa.int32()), ("chunk", pa.int32()), ("query_id", pa.int64()), ("q", pa.binary())])
        for b in batches:
            ids, blobs = b["vec_id"].to_numpy(), b["v"].to_pylist()
            q = _matrix(blobs, pivots.shape[1])
            s = _products(q, seed_v).astype(np.float64)
            s[ids[:, None] == seed_ids[None, :]] = -np.inf
            floor = np.sort(s, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(q), -np.inf)
            bound = q @ _fit(centers, q.shape[1]).T + np.sqrt((q * q).sum(1))[:, None] * radius
            need = bound * (1 + 1e-9 * np.sign(bound)) + 1 >= floor[:, None]
            out = [(int(groups[j]), c, int(ids[i]), blobs[i]) for i, j in zip(*np.nonzero(need), strict=True) for c in range(chunks[j])]
            for at in range(0, len(out), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 8192], strict=True), schema.types, strict=True)], schema=schema)

    if n_chunks is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = grouped.filter(F.col("vec_id") % every == 0).select("vec_id", "v").distinct()
    n_blocks = max(1, -(-asked.count() // block_queries))
    queries = asked.mapInArrow(place, "g int, chunk int, query_id long, q binary").withColumn("block", F.pmod(F.xxhash64("query_id", "q"), F.lit(n_blocks)).cast("int"))
    queries = materialize(queries, "queries")
    parts = grouped.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.element_at(n_chunks, F.col("g"))).cast("int"))
    # What the bounds leave: the blocks that need a group, n_pivots of each block at most.
    needed = queries.select(F.col("g").alias("__g"), F.col("block").alias("__block")).distinct()
    parts = parts.join(needed, F.col("g") == F.col("__g")).select("g", "chunk", F.col("__block").alias("block"), "vec_id", "v")
    keys = ["g", "chunk", "block"]

    def solve(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "q": [], "vec_id": [], "score": []}
        if len(x) and len(q):
            x = x.sort_values("vec_id", kind="stable")
            ids, m = x["vec_id"].to_numpy(), _matrix(list(x["v"]))
            for at in range(0, len(q), 256):
                part = q.iloc[at : at + 256]
                asks, blobs = part["query_id"].to_numpy(), part["q"].to_numpy()
                s = _products(_matrix(list(blobs)), m)
                own = asks[:, None] == ids[None, :]
                s[own] = -LONG - 1
                i, j = np.nonzero(_best(s, k) & ~own)
                for name, values in (("query_id", asks[i]), ("q", blobs[i]), ("vec_id", ids[j]), ("score", s[i, j])):
                    found[name].append(values)
        return pd.DataFrame({n: np.concatenate(v) if v else [] for n, v in found.items()})

    local = parts.select(*keys, "vec_id", "v").groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(solve, "query_id long, q binary, vec_id long, score long")
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    drop_table(data)
    return ranked
