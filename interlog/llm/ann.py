"""Approximate nearest neighbours by a permutation index.

Vectors of a bounded sample that lie farthest from each other serve as pivots, so that a large group of near
copies does not fill them. Every vector is represented by its nearest pivots in order, and is posted with its rank
in the inverted file of each of them. The index is dealt out in blocks of vectors; a task meets one chunk of
queries with one block, adds up the footrule distance along the postings of a query's pivots, and reranks the
block's nearest by the cosine of the original vectors.

Identical vectors are indexed once and answer with their smallest ids.

Defined results: vectors that are null, zero, or hold null or non-finite components, or whose length is not the
table's commonest, take no part; queries with too few candidates get all of them; rows with equal ids are one
vector; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from interlog.llm.vector_dedup import usable
from interlog.session import cut_lineage

SAMPLE_BYTES = 1 << 26


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spread(x: np.ndarray, pivots: int) -> np.ndarray:
    """Rows of ``x``, each the one whose largest cosine to the rows before it is smallest."""
    u = unit(x)
    chosen, near = [0], u @ u[0]
    near[0] = np.inf
    while len(chosen) < min(pivots, len(x)):
        own = int(np.argmin(near))
        chosen.append(own)
        near = np.maximum(near, u @ u[own])
        near[own] = np.inf
    return x[chosen]


def ranks(x: np.ndarray, pivots: np.ndarray, kept: int) -> np.ndarray:
    """(rows, pivots): a pivot's place in the order of nearness, ``kept`` beyond the nearest ``kept``."""
    order = np.argsort(-(unit(x) @ unit(pivots).T), axis=1, kind="stable")[:, :kept]
    out = np.full((len(x), len(pivots)), kept, np.int16)
    np.put_along_axis(out, order, np.arange(kept, dtype=np.int16)[None, :], axis=1)
    return out


class Block:
    """The inverted files of a block of vectors."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray, kept: int):
        self.x, self.norm, self.kept, self.pivots = x, np.linalg.norm(x, axis=1), kept, pivots
        place = ranks(x, pivots, kept)
        self.files = [(ids := np.flatnonzero(place[:, p] < kept), place[ids, p].astype(np.int32)) for p in range(len(pivots))]

    def footrule(self, place: np.ndarray) -> np.ndarray:
        """Footrule distance to every vector of the block, less what all of them have in common."""
        out = np.zeros(len(self.x), np.int32)
        for p in np.flatnonzero(place < self.kept):
            ids, other = self.files[p]
            mine = int(place[p])
            out[ids] += np.abs(other - mine) - (self.kept - other) - (self.kept - mine)
        return out

    def nearest(self, q: np.ndarray, place: np.ndarray, reranked: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        distance = self.footrule(place)
        rows = np.argpartition(distance, reranked - 1)[:reranked] if reranked < len(distance) else np.arange(len(distance))
        cosine = np.einsum("ij,j->i", self.x[rows], q) / (self.norm[rows] * np.linalg.norm(q))
        best = np.lexsort((rows, -cosine))[:wanted]
        return rows[best], cosine[best]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def search(vectors: DataFrame, queries: F.Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
           pivots: int = 256, sample: int = 16384, part: float = 0.04, least: int = 512, block: int = 8192, chunk: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest of each row that the condition ``queries`` picks.

    ``pivots`` vectors are picked from ``sample`` distinct ones in hash order (fewer of them where they are more
    than 64 MB); half of them describe a vector. Of each block the nearest ``part``, ``least`` at least, are reranked.
    """
    slim = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"))
    points = usable(slim.where("vec_id is not null"), "vec_id", "v").withColumn("dim", F.length("x"))
    common = points.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return empty
    points = cut_lineage(points.where(F.col("dim") == common["dim"]).withColumn("digest", F.unhex(F.md5("x"))), "points")
    by_vector = Window.partitionBy("digest").orderBy("vec_id")
    few = (points.select("digest", "vec_id").distinct().withColumn("place", F.row_number().over(by_vector))
           .where(F.col("place") <= k + 1).groupBy("digest").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    classes = points.groupBy("digest").agg(F.first("x").alias("x")).join(few, "digest").select(
        "digest", F.col("ids")[0].alias("rep"), "ids", "x")
    classes = cut_lineage(classes, "vector_classes")
    asked = points.where(queries).groupBy("vec_id").agg(F.first("x").alias("x"))
    n, m = classes.count(), asked.count()
    sample = max(pivots, min(sample, SAMPLE_BYTES // common["dim"]))
    drawn = classes.orderBy(F.xxhash64("digest"), "digest").limit(sample).select("x").toPandas()   # bounded by ``sample``
    base = spread(_matrix(drawn["x"]), pivots)
    kept = max(1, len(base) // 2)
    blocks, chunks = -(-n // block), max(1, -(-m // chunk))
    one = classes.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                         F.pmod(F.xxhash64("digest"), F.lit(blocks)).alias("block"), F.lit(None).cast("long").alias("query_id"),
                         "ids", "x")
    two = asked.select(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                       F.col("vec_id").alias("query_id"), F.lit(None).cast("array<long>").alias("ids"), "x")

    def meet(tile: pd.DataFrame) -> pd.DataFrame:
        held, asking = tile[tile["query_id"].isna()], tile[tile["query_id"].notna()]
        rows: list[tuple] = []
        if len(held) and len(asking):
            index, ids = Block(_matrix(held["x"]), base, kept), held["ids"].to_numpy()
            q = _matrix(asking["x"])
            for own, x, place in zip(asking["query_id"].astype("int64"), q, ranks(q, base, kept), strict=True):
                found, cosine = index.nearest(x, place, max(least, int(part * len(held))), k + 1)
                rows += [(own, int(i), float(c)) for r, c in zip(found, cosine, strict=True) for i in ids[r] if i != own]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = one.union(two).groupBy("chunk", "block").applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
