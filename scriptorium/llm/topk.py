"""Operator 8: exact top-k inner-product search by pivot-table elimination.

The engine keeps, for each vector, its distances to PIVOTS pivots (picked far apart from a bounded sample of
PIVOT_SAMPLE rows, those with the smallest hashes). For a query q and a candidate x the triangle inequality bounds
|q - x| from below by the largest |d(q, p) - d(x, p)|, so q.x is at most (|q|^2 + |x|^2 - bound^2) / 2. Candidates of
a block are taken in the order of that bound, CHUNK at a time, until the k-th best score lies above the next bound; equal
bounds are still evaluated, so ties go to the smaller id and the result is exact. The k-th best score among the rows of
the sample is a first limit, and a task carries the best of a query block from one candidate block to the next.

Candidates and queries are packed into blocks, each a row with three byte strings. Where there are several blocks of
queries of a length, queries and candidates are dealt by their nearest pivot first, so that a block's distances to a pivot
lie close together. A pair of blocks is dropped by the same bound, taken over the intervals of their distances, before anything but
intervals is shuffled; the intervals of up to ``broadcast_blocks`` query blocks are broadcast, more meet by shuffle. Queries
of up to ``broadcast_bytes`` are broadcast to the candidates; beyond that the pairs that are left meet in an equi-join on
(length, query block, slice). A task holds one block of candidates and RUNS of queries at a time. Each run of meetings
returns k rows for a query, and a window keeps the k best of them.

Components become floor(scale * x), as integers. Scores are worked out in float64 where all sums of products stay below
2^53, in int64 below 2^63, and beyond that the search raises. Distances are kept as float32, with a margin of 1e-6 of their
size for rounding. Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor do
rows with a null id; vectors meet those of their own length, and each length has pivots of its own; an empty table, or no
query, gives no rows; rows with the same id are candidates each for itself, and none of them for the queries of that id;
fewer candidates than k are all returned; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, slots, table

#: Query blocks whose best a task carries at a time.
RUNS = 16
SCALE, K, PIVOTS, PIVOT_SAMPLE, BLOCK, QUERY_BLOCK, CHUNK = 1024, 10, 32, 2048, 4096, 1024, 64


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id and v (array of long) of the rows that take part."""
    ok = F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    own = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x")).filter(F.col("vec_id").isNotNull() & ok)
    return own.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those before it."""
    if not len(sample):
        return sample.astype(np.float64)
    x = sample.astype(np.float64)
    out = [int(np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1)))]
    gap = ((x - x[out[0]]) ** 2).sum(axis=1)
    while len(out) < min(n, len(x)) and gap.max() > 0:
        out.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[out[-1]]) ** 2).sum(axis=1))
    return x[out]


def pivot_table(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0)).astype(np.float32)


def _kind(q: np.ndarray, x: np.ndarray) -> type:
    """The number type in which every inner product of q and x is exact."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most >= 2**63:
        raise OverflowError("a score may not fit 64 bits")
    return np.float64 if most < 2**53 else np.int64


def search_block(qid: np.ndarray, q: np.ndarray, qd: np.ndarray, xid: np.ndarray, x: np.ndarray, xd: np.ndarray, best: list, floor: np.ndarray, k: int, chunk: int = CHUNK) -> int:
    """Takes a block of candidates into best, (scores, ids) of each query with the best first. floor: a score for each query
    that its k-th best reaches in any case. Returns the number of scores computed."""
    kind, done = _kind(q, x), 0
    xf, qf = x.astype(kind), q.astype(kind)
    x2, q2 = (x.astype(np.float64) ** 2).sum(axis=1), (q.astype(np.float64) ** 2).sum(axis=1)
    xd, qd = xd.astype(np.float64), qd.astype(np.float64)
    margin = 1e-6 * (1 + np.sqrt(x2) + np.abs(xd).max(axis=1, initial=0))
    for i in range(len(qid)):
        low = np.abs(xd - qd[i]).max(axis=1) if xd.shape[1] else np.zeros(len(x))
        low = np.maximum(low - margin - 1e-6 * (np.sqrt(q2[i]) + np.abs(qd[i]).max(initial=0)), 0)
        bound = (q2[i] + x2) * (0.5 + 1e-12) - low * low / 2 + 0.5
        best_s, best_id = best[i]
        limit = max(floor[i], best_s[-1]) if len(best_s) == k else floor[i]
        open_ = np.flatnonzero((xid != qid[i]) & (bound >= limit))
        order = open_[np.argsort(-bound[open_], kind="stable")]
        at, size = 0, chunk
        while at < len(order):
            if len(best_s) == k and bound[order[at]] < best_s[-1]:
                break
            own = order[at : at + size]
            s = np.concatenate([best_s, (xf[own] @ qf[i]).astype(np.int64)])
            ids = np.concatenate([best_id, xid[own]])
            keep = np.lexsort((ids, -s))[:k]
            best_s, best_id = s[keep], ids[keep]
            done += len(own)
            at += size
            size *= 2
        best[i] = best_s, best_id
    return done


def floors(qid: np.ndarray, q: np.ndarray, sample_id: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """For each query the k-th best score among the sample's rows, -inf where it has fewer than k others."""
    out = np.full(len(qid), -np.inf)
    if len(sample) < k:
        return out
    kind = _kind(q, sample)
    s = (q.astype(kind) @ sample.astype(kind).T).astype(np.float64)
    s[qid[:, None] == sample_id[None]] = -np.inf
    return np.nextafter(np.partition(s, len(sample) - k, axis=1)[:, len(sample) - k], -np.inf)


BLOCK_SCHEMA = "n long, dim int, ids binary, vectors binary, distances binary, low array<double>, high array<double>, square double, floor double"


def blocks(vectors: DataFrame, pivots: dict, size: int, k: int = 0) -> DataFrame:
    """Vectors in rows of up to size of one length, with their pivot table, its least and greatest distance to each pivot, the
    greatest squared length and, for k, the least floor of a query. pivots: (pivots, sample ids, sample) for each length."""

    def pack(batches):
        for whole in batches:
            lengths = pc.list_value_length(whole.column("v")).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                own = whole.filter(pa.array(lengths == dim))
                for at in range(0, own.num_rows, size):
                    batch = own.slice(at, size)
                    x = np.asarray(batch.column("v").flatten(), np.int64).reshape(batch.num_rows, dim)
                    ids = np.asarray(batch.column("vec_id"), np.int64)
                    d = pivot_table(x, pivots[dim][0])
                    floor = float(floors(ids, x, *pivots[dim][1:], k).min()) if k else 0.0
                    square = float((x.astype(np.float64) ** 2).sum(axis=1).max())
                    yield pa.RecordBatch.from_pydict({
                        "n": [len(ids)], "dim": pa.array([dim], pa.int32()), "ids": [ids.tobytes()], "vectors": [x.astype(np.int32 if np.abs(x).max() < 2**31 else np.int64).tobytes()], "distances": [d.tobytes()],
                        "low": pa.array([d.min(axis=0).astype(float).tolist()], pa.list_(pa.float64())), "high": pa.array([d.max(axis=0).astype(float).tolist()], pa.list_(pa.float64())), "square": [square], "floor": [floor],
                    })

    return vectors.mapInArrow(pack, BLOCK_SCHEMA)


def length_pivots(vectors: DataFrame, n_pivots: int) -> dict:
    """(pivots, sample ids, sample) of each length, from about PIVOT_SAMPLE rows in all: a length's share of them, n_pivots at
    least if it has so many."""
    own = vectors.select("vec_id", "v", F.size("v").alias("dim"), F.xxhash64("vec_id", "v").bitwiseAND(F.lit((1 << 63) - 1)).alias("h"))
    counts = own.groupBy("dim").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()
    if not counts:
        return {}
    total = sum(r["n"] for r in counts)
    limit = lambda r, rows: (1 << 63) - 1 if r["n"] <= rows else max(r["least"], (rows << 63) // r["n"])
    limits = vectors.sparkSession.createDataFrame([(r["dim"], limit(r, max(2 * n_pivots, PIVOT_SAMPLE * r["n"] // total))) for r in counts], "dim int, upto long")
    # rows that are equal have one hash, so they are drawn together: each is taken once
    sample: dict[int, list] = {}
    for r in own.join(F.broadcast(limits), "dim").filter("h <= upto").select("h", "vec_id", "v").distinct().orderBy("h", "vec_id").toLocalIterator():
        sample.setdefault(len(r["v"]), []).append((r["vec_id"], r["v"]))
    out = {}
    for dim, rows in sample.items():
        x = np.array([v for _, v in rows], np.int64)
        out[dim] = pick_pivots(x, n_pivots), np.array([i for i, _ in rows], np.int64), x
    return out


def with_nearest(vectors: DataFrame, pivots: dict) -> DataFrame:
    """vec_id, v, dim and the number of the nearest pivot."""

    def nearest(batches):
        for batch in batches:
            lengths = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False).astype(np.int32)
            out = np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(lengths).tolist():
                own = lengths == dim
                x = np.asarray(batch.column("v").filter(pa.array(own)).flatten(), np.int64).reshape(-1, dim)
                out[own] = pivot_table(x, pivots[dim][0]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(lengths), pa.array(out)], names=["vec_id", "v", "dim", "pivot"])

    return vectors.mapInArrow(nearest, "vec_id long, v array<long>, dim int, pivot int")


def _unpack(n: int, dim: int, ids: bytes, vectors: bytes, distances: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.int32 if len(vectors) == 4 * n * dim else np.int64
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, kind).reshape(n, dim), np.frombuffer(distances, np.float32).reshape(n, -1)


def exact_top_k(vectors: DataFrame, is_query, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, scale: int = SCALE, n_pivots: int = PIVOTS, block: int = BLOCK, query_block: int = QUERY_BLOCK, broadcast_blocks: int = 4096, broadcast_bytes: int = 8 << 20, counts: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row for which is_query(id column) holds. With counts,
    in their place query_block, pairs and evaluated of each run of meetings: what the elimination had left to do."""
    spark = vectors.sparkSession
    own = materialise(integer_vectors(vectors, id_col, vec_col, scale), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = length_pivots(own, n_pivots)
    if not pivots:
        return empty
    n_slices = slots(spark)
    asked = own.filter(is_query(F.col("vec_id")))
    many = any(r["count"] > query_block for r in asked.groupBy(F.size("v")).count().collect())  # a row for each length

    def dealt(df, n):
        if many:
            return with_nearest(df, pivots).repartitionByRange(n, "dim", "pivot", "vec_id").sortWithinPartitions("dim", "pivot").select("vec_id", "v")
        return df.sortWithinPartitions(F.size("v")) if len(pivots) > 1 else df  # so that a batch holds few lengths

    asked = blocks(dealt(asked, n_slices) if many else dealt(asked.coalesce(n_slices), n_slices), pivots, query_block, k)
    queries = materialise(asked.withColumn("block", F.monotonically_increasing_id()), "queries")
    # blocks are numbered without what they hold: two numbers for each query_block queries
    number = queries.select("block", (F.row_number().over(Window.partitionBy("dim").orderBy("block")) - 1).alias("qb"))
    number = materialise(number, "numbers")
    slim = queries.select("block", "dim", "low", "high", "square", "floor").join(number, "block").drop("block")
    n_blocks = slim.groupBy("dim").agg(F.count("*").alias("n_blocks")).collect()  # a row for each length
    if not n_blocks:
        return empty
    pieces = materialise(blocks(dealt(own, n_slices), pivots, block).withColumn("block", F.monotonically_increasing_id()), "candidates")
    discard(own)
    slim = slim.select("dim", "qb", F.col("low").alias("q_low"), F.col("high").alias("q_high"), F.col("square").alias("q_square"), "floor")
    # how far apart two blocks' distances to a pivot are at least
    gaps = F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("q_low", "q_high"), lambda x, q: F.greatest(x["low"] - q["q_high"], q["q_low"] - x["high"]) - F.lit(4e-6) * (1 + x["high"] + q["q_high"]))
    gap = F.greatest(F.coalesce(F.array_max(gaps), F.lit(0.0)) - F.lit(4e-6) * (F.sqrt("square") + F.sqrt("q_square")), F.lit(0.0))
    near = (F.col("square") + F.col("q_square")) * (0.5 + 1e-12) - gap * gap / 2 + 0.5 >= F.col("floor")
    held = ["n", "ids", "vectors", "distances"]
    bounds = ["block", "dim", "low", "high", "square"]
    if sum(r["n_blocks"] for r in n_blocks) <= broadcast_blocks:
        met = pieces.select(*bounds, *held).join(F.broadcast(slim), "dim").filter(near)
    else:
        few = spark.createDataFrame([tuple(r) for r in n_blocks], "dim int, n_blocks long")
        tried = pieces.select(*bounds).join(few, "dim").withColumn("qb", F.explode(F.sequence(F.lit(0), (F.col("n_blocks") - 1).cast("int"))))
        met = tried.join(slim, ["dim", "qb"]).filter(near).select("block", "dim", "qb").join(pieces.select("block", *held), "block")
    sides = queries.join(number, "block").select("dim", "qb", *(F.col(c).alias(f"q_{c}") for c in held))
    size = queries.agg(F.sum(F.octet_length("ids") + F.octet_length("vectors") + F.octet_length("distances"))).first()[0]
    if size <= broadcast_bytes:
        met = met.join(F.broadcast(sides), ["dim", "qb"])
    else:  # each slice of the candidates has its copy of the queries
        n_slices = max(1, min(n_slices, pieces.count()))
        met = met.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(n_slices)))
        met = met.join(sides.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slices - 1).cast("long")))), ["dim", "qb", "slice"])

    def search(batches):
        runs: dict = {}  # of each query block at hand: ids, vectors, distances, floors, best, pairs, evaluated

        def out():
            if counts:
                yield pa.RecordBatch.from_pydict({"query_block": [qb for _, qb in runs], "pairs": [r[5] for r in runs.values()], "evaluated": [r[6] for r in runs.values()]})
                return
            for qid, _, _, _, best, _, _ in runs.values():
                at = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
                yield pa.RecordBatch.from_arrays([pa.array(qid[at]), pa.array(np.concatenate([i for _, i in best])), pa.array(np.concatenate([s for s, _ in best]))], names=["query_id", "vec_id", "score"])

        for whole in batches:
            for i in range(whole.num_rows):
                row = whole.slice(i, 1).to_pylist()[0]
                dim, key = row["dim"], (row["dim"], row["qb"])
                xid, x, xd = _unpack(row["n"], dim, *(row[c] for c in held[1:]))
                if key not in runs:
                    if len(runs) >= RUNS:
                        yield from out()
                        runs.clear()
                    qid, q, qd = _unpack(row["q_n"], dim, *(row[f"q_{c}"] for c in held[1:]))
                    runs[key] = [qid, q, qd, floors(qid, q, *pivots[dim][1:], k), [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in qid], 0, 0]
                run = runs[key]
                run[5] += len(run[0]) * len(xid)
                run[6] += search_block(*run[:3], xid, x, xd, run[4], run[3], k)
        if runs:
            yield from out()

    met = met.select("dim", "qb", *held, *(f"q_{c}" for c in held))
    if counts:
        return met.mapInArrow(search, "query_block long, pairs long, evaluated long")
    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    # queries with equal ids are rows of their own, with equal ids and often equal results: ranks are over the id
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
