"""Centroid clustering (Lloyd rounds) over subvector dictionaries.

The integer vectors are written once as segments of some thousand rows.  In a
segment every block of dimensions is dictionary-encoded, without loss: the
distinct subvectors, and one code a row.  A block starts ``WIDTH`` dimensions
wide and is halved as long as its dictionary is longer than half the rows, so
blocks are as wide as the data repeat.  A round works out the exact distances of
the distinct subvectors to the centroids' blocks, once each, and adds the
partial distances up by code; the sums for the new centroids come from counts
of (cluster, code) in the same way.

A segment is bounded by the Arrow batch, so a task holds a batch and its
dictionaries, whatever the corpus; no vector is shuffled, and a round sends the
driver (clusters x dimensions) sums.  All arithmetic is in integers, so neither
the order of rows nor the segments change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Dimensions of a block before it is halved.
WIDTH = 8
#: Integer components beyond this have squared distances that a long may not hold.
LARGEST = 1 << 26
SEGMENT = "ids array<string>, widths array<int>, dictionaries array<binary>, codes array<binary>"


def integers(vector: Column, dims: int = DIMS, scale: int = SCALE) -> tuple[Column, Column]:
    """Whether a vector is kept (``dims`` finite components), and its components as integers floor(scale * x)."""
    x = lambda v: v.cast("double")
    kept = (F.size(vector) == dims) & ~F.exists(vector, lambda v: v.isNull() | F.isnan(x(v)) | (F.abs(x(v)) == float("inf")))
    large = F.exists(vector, lambda v: F.abs(x(v)) * scale > LARGEST)
    whole = F.when(large, F.raise_error(F.lit(f"a component beyond {LARGEST // scale} has no exact distance in a long"))) \
        .otherwise(F.transform(vector, lambda v: F.floor(x(v) * scale).cast("long")))
    return F.coalesce(kept, F.lit(False)), whole


def encode_block(a: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct subvectors, codes) of the blocks that the columns of ``a`` fall into, from left to right."""
    for at in range(0, a.shape[1], width):
        part = np.ascontiguousarray(a[:, at:at + width])
        distinct, codes = np.unique(part, axis=0, return_inverse=True)
        if part.shape[1] > 1 and 2 * len(distinct) > len(a):
            yield from encode_block(part, (part.shape[1] + 1) // 2)
        else:
            yield distinct, codes.reshape(-1)


def _segments(vectors: DataFrame, dims: int, width: int) -> DataFrame:
    """One row a segment, from rows (id, v)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            a = np.stack(b["v"].to_numpy()).astype(np.int32)
            blocks = list(encode_block(a, width))
            yield pd.DataFrame({
                "ids": [b["id"].tolist()], "widths": [[d.shape[1] for d, _ in blocks]],
                "dictionaries": [[d.tobytes() for d, _ in blocks]],
                "codes": [[c.astype(np.min_scalar_type(len(d) - 1)).tobytes() for d, c in blocks]]})

    return vectors.mapInPandas(run, SEGMENT)


def blocks_of(segment) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first dimension, distinct subvectors, codes) of each block of a segment."""
    at = 0
    for width, d, c in zip(segment.widths, segment.dictionaries, segment.codes):
        distinct = np.frombuffer(d, dtype=np.int32).reshape(-1, width).astype(np.int64)
        codes = np.frombuffer(c, dtype=np.min_scalar_type(len(distinct) - 1))
        yield at, distinct, codes
        at += width


def nearest(segment, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the smaller number) and its squared distance."""
    total = np.zeros((len(segment.ids), len(centroids)), dtype=np.int64)
    for at, distinct, codes in blocks_of(segment):
        partial = np.stack([((distinct - c[at:at + distinct.shape[1]])**2).sum(axis=1) for c in centroids], axis=1)
        total += partial[codes]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(total)), best]


def cluster_sums(segment, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and component sums of each cluster in a segment."""
    best, _ = nearest(segment, centroids)
    k = len(centroids)
    sums = np.zeros(centroids.shape, dtype=np.int64)
    for at, distinct, codes in blocks_of(segment):
        met = np.bincount(best * len(distinct) + codes, minlength=k * len(distinct)).reshape(k, -1)
        sums[:, at:at + distinct.shape[1]] = met @ distinct
    return np.bincount(best, minlength=k), sums


def _next_centroids(segments: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count); clusters without rows keep their centroid."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=np.int64)
        for b in batches:
            for segment in b.itertuples():
                more, parts = cluster_sums(segment, centroids)
                n, sums = n + more, sums + parts
        yield pd.DataFrame({"cluster": range(len(n)), "n": n, "sums": list(sums)})

    got = segments.mapInPandas(run, "cluster int, n long, sums array<long>").select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    out = centroids.copy()
    for r in got.groupBy("cluster", "at").agg(exact("n").alias("n"), exact("part").alias("total")).collect():
        if r["n"]:
            out[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])  # floors, also below zero
    return out


def first_centroids(vectors: DataFrame, k: int, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``seed:id``, in its order (equal ids: by components; null ids last)."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id")).cast("binary"), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def cluster_vectors(vectors: DataFrame, *, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
                    seed: int = SEED, width: int = WIDTH, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each kept vector.

    Vectors that are null, of another length, or that hold a null or non-finite
    component are left out.  With fewer than ``k`` vectors each starts a cluster.
    Equal vectors share a cluster; repeated rows and ids count each time; a null
    id is kept as null.  An empty table gives no rows.  Other columns are
    ignored, whatever their names.  A component whose integer lies beyond 2**26
    raises an error, since distances would not fit.
    """
    ids = vectors.schema[id_col].dataType
    kept, whole = integers(F.col(vec_col), dims, scale)
    rows = vectors.where(kept).select(F.col(id_col).cast("string").alias("id"), whole.alias("v"))
    centroids = first_centroids(rows, k, seed).reshape(-1, dims)
    segments = staged(_segments(rows, dims, width), "segments")
    for _ in range(rounds if len(centroids) else 0):
        new = _next_centroids(segments, centroids)
        if (new == centroids).all():
            break  # later rounds would change nothing
        centroids = new

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for segment in b.itertuples():
                best, distance = nearest(segment, centroids)
                yield pd.DataFrame({"id": list(segment.ids), "cluster": best, "distance": distance})

    placed = staged(segments.mapInPandas(run, "id string, cluster int, distance long"), "assigned")
    far = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    of_cluster = lambda values, kind: F.element_at(F.array(*[F.lit(v) for v in values] or [F.lit(None)]).cast(f"array<{kind}>"),
                                                   F.col("cluster") + 1)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return placed.select(
        F.col("id").cast(ids).alias(id_col), "cluster", "distance",
        of_cluster([far.get(c, 0) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(far.values())).cast("long").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"))


def op11_subvector_clusters(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds spelled out, one component a row."""
    parts = [f"""kept AS (SELECT row_number() OVER () AS r, vec_id, [floor(x::DOUBLE * {SCALE})::BIGINT FOR x IN embedding] AS v
      FROM embeddings WHERE len(embedding) = {DIMS}
        AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0)""",
             "flat AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept)",
             f"""c0 AS MATERIALIZED (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS d
      FROM (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS k, v FROM kept) WHERE k < {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(k, (dist, k)) AS k, min(dist) AS dist FROM (
      SELECT r, k, sum((f.x - c.x) * (f.x - c.x)) AS dist FROM flat f JOIN c{i} c USING (d) GROUP BY r, k) GROUP BY r)""")
        if i < ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.k, c.d, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{i} c
      LEFT JOIN (SELECT k, d, sum(x) AS s, count(*) AS n FROM flat JOIN a{i} USING (r) GROUP BY k, d) USING (k, d))""")
    last = ROUNDS
    return "WITH " + ",\n    ".join(parts) + f"""
    SELECT vec_id, a.k::INTEGER AS cluster, a.dist::BIGINT AS distance,
      (sum(a.dist) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(a.dist) OVER ())::BIGINT AS inertia,
      h.digest AS centroid_sha256
    FROM a{last} a JOIN kept USING (r)
      JOIN (SELECT k, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d)) AS digest FROM c{last} GROUP BY k) h ON h.k = a.k"""


OP11_SQL = _sql()
