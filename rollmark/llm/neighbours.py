"""Approximate nearest neighbours: inverted lists that are scanned by adaptive dimensions.

Vectors are normalised and rotated by a random orthogonal matrix, so that any block of columns is
a fair sample of a vector. Every vector belongs to the list of its nearest centroid. A query goes
through the lists whose centroids are nearest to it. In a list, partial squared distances are
summed block of columns after block of columns; after each block a hypothesis test drops the
candidates whose distance, projected from the part seen, is larger than the current k-th best by
more than chance allows (error EPSILON / sqrt(columns seen)). What is left is measured exactly on
the original vectors in double precision.

Lists are cut into parts of at most PART vectors, and the queries of a part into blocks, so a list
with any share of all vectors is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from rollmark.plans.session import scratch_path

#: Rows that centroids are fitted on; vectors per list aimed at, and lists at most.
SAMPLE, PER_LIST, LISTS = 20_000, 2000, 1024
#: Share of the lists that a query goes through.
PROBED = 0.9
#: Vectors of a list's part; queries of a block; columns of a block; strictness of the test.
PART, QUERIES, COLUMNS, EPSILON = 4096, 1024, 16, 2.1


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float64) for v in values]) if len(values) else np.zeros((0, 0))


def rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(3).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def centroids(x: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means on normalised rows."""
    lists = max(1, min(lists, len(x)))
    c = x[np.random.default_rng(4).choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        new = np.zeros_like(c)
        np.add.at(new, near, x)
        n = np.linalg.norm(new, axis=1, keepdims=True)
        c = np.where(n > 0, new / np.maximum(n, 1e-12), c)
    return c


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) with v as an array of doubles, of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.exists("v", lambda x: x != 0.0))


def adaptive_scan(q: np.ndarray, x: np.ndarray, k: int, epsilon: float = EPSILON, columns: int = COLUMNS) -> list[np.ndarray]:
    """For each rotated query, row numbers of x that may be among its k nearest."""
    n, width = x.shape
    blocks = [np.ascontiguousarray(x[:, c : c + columns]) for c in range(0, width, columns)]
    head = blocks[0]
    head_norm = (head**2).sum(axis=1)
    out = []
    for row in q:
        part = head_norm - 2 * (head @ row[:columns]) + (row[:columns] ** 2).sum()
        alive = np.arange(n)
        if n > k:
            first = np.argpartition(part, k)[: 4 * k]
            bound = np.partition(((x[first] - row) ** 2).sum(axis=1), k - 1)[k - 1]
            for b, block in enumerate(blocks[1:], 2):
                seen = min((b - 1) * columns, width)
                keep = part * (width / seen) <= bound * (1 + epsilon / np.sqrt(seen)) ** 2 + 1e-9
                alive, part = alive[keep], part[keep]
                diff = block[alive] - row[(b - 1) * columns : b * columns]
                part = part + (diff**2).sum(axis=1)
            if len(alive) > k:
                limit = max(bound, 0.0) if len(alive) < k else np.partition(part, k - 1)[k - 1]
                alive = alive[part <= limit + 1e-9]
        out.append(alive)
    return out


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always summed in the same order, so equal vectors give equal scores."""
    dot = np.array([float(np.dot(x, y)) for x, y in zip(a, b)])
    na = np.array([float(np.dot(x, x)) for x in a])
    nb = np.array([float(np.dot(y, y)) for y in b])
    return dot / np.sqrt(na * nb)


def _scanner(turn: np.ndarray, k: int, epsilon: float, columns: int):
    def run(key: tuple, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        if not len(queries) or not len(members):
            return none
        members = members.sort_values("vec_id")
        q, x = _matrix(queries["v"]), _matrix(members["v"])
        ids, own = members["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        turned_x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turn
        turned_q = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ turn
        rows = []
        for number, near in enumerate(adaptive_scan(turned_q, turned_x, k + 1, epsilon, columns)):
            near = near[ids[near] != own[number]]
            score = cosine(np.broadcast_to(q[number], (len(near), q.shape[1])), x[near])
            best = np.lexsort((ids[near], -score))[:k]
            rows.append(pd.DataFrame({"query_id": own[number], "vec_id": ids[near][best], "score": score[best]}))
        return pd.concat(rows) if rows else none

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
    probed: float = PROBED, sample: int = SAMPLE, epsilon: float = EPSILON, columns: int = COLUMNS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found among the other vectors by
    cosine, ties to the smaller id; all of them if there are fewer.

    Vectors that are null, zero, or hold a null or non-finite component take no part on either
    side, and vectors of another length than most of the sample's have lists of their own kind:
    they are left out too, as their cosine to the others is not defined. Repeated rows of one
    vec_id count once. Other columns are not read. No vectors or no queries give no rows.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "vectors")
    out = "query_id bigint, vec_id bigint, score double"
    all_rows = usable(vectors, vec_id, embedding).groupBy("vec_id").agg(F.first("v").alias("v"))
    all_rows.write.parquet(path)
    base = spark.read.parquet(path)
    lengths = base.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width, total = lengths[0]["width"], lengths[0]["count"]
    base = base.filter(F.size("v") == width)
    share = min(1.0, 1.2 * sample / total)
    fitted = base.filter(F.pmod(F.xxhash64(F.lit("fit"), "vec_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    x = np.array([r.v for r in fitted.select("v").limit(sample).collect()], float).reshape(-1, width)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = int(min(LISTS, max(4, total // PER_LIST, np.sqrt(total) // 8)))
    centre = spark.sparkContext.broadcast(centroids(x, lists) if len(x) else np.eye(1, width))  # at most LISTS rows

    def unit(v: pd.Series) -> np.ndarray:
        m = np.stack(v.to_numpy()).astype(float)
        return m, m / np.linalg.norm(m, axis=1, keepdims=True)

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                m, u = unit(f["v"])
                yield pd.DataFrame({"vec_id": f["vec_id"], "list": np.argmax(u @ centre.value.T, axis=1),
                                    "v": [r.tobytes() for r in m]})

    def probing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        share = int(np.ceil(probed * len(centre.value)))
        for f in frames:
            if len(f):
                m, u = unit(f["v"])
                order = np.argsort(-(u @ centre.value.T), axis=1)
                held = np.cumsum(list_sizes[order], axis=1)  # as many lists as hold enough candidates, at least
                many = np.minimum(np.maximum(share, (held <= 20 * k).sum(axis=1) + 1), order.shape[1])
                yield pd.DataFrame({
                    "query_id": np.repeat(f["vec_id"].to_numpy(), many),
                    "list": np.concatenate([row[:n] for row, n in zip(order, many)]),
                    "v": np.repeat(np.array([r.tobytes() for r in m], dtype=object), many)})

    index = base.mapInPandas(placed, "vec_id bigint, list int, v binary")
    parts = F.ceil(F.col("size") / PART).cast("int")
    sizes = index.groupBy("list").agg(F.count("*").alias("size"))
    list_sizes = np.zeros(len(centre.value), np.int64)  # a number per list
    for r in sizes.collect():
        list_sizes[r["list"]] = r["size"]
    sizes = spark.createDataFrame([(i, int(n)) for i, n in enumerate(list_sizes)], "list int, size bigint")
    index = index.join(F.broadcast(sizes), "list").withColumn(  # a row per list
        "part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
    asked = base.join(queries.select(F.col(vec_id).cast("bigint").alias("vec_id")).distinct(), "vec_id", "left_semi")
    asked = asked.mapInPandas(probing, "query_id bigint, list int, v binary").join(F.broadcast(sizes), "list")
    blocks = F.lit(max(1, -(-queries.select(vec_id).distinct().count() // QUERIES)))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn(
        "block", F.pmod(F.xxhash64("query_id"), blocks).cast("int"))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = ["list", "part", "block"]
    found = asked.select(*key, "query_id", "v").groupBy(*key).cogroup(index.select(*key, "vec_id", "v").groupBy(*key)).applyInPandas(
        _scanner(rotation(width), k, epsilon, columns), out)
    # of each task's finds the k best per query are kept before the shuffle; a list's part gives k at most
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

