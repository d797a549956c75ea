"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors of one label link when their cosine reaches the threshold, that is when their squared distance is
at most ``2 - 2 * threshold``. After a fixed random rotation the vectors are split into blocks; a linked pair
lies, in one block at least, within that block's proportional part of the squared distance. Each block is
joined by range: a vector has a home cell on the block's first coordinate and visits the cells that its radius
reaches. What a block's distance lets pass is verified by the cosine of the original vectors, in the pair's
first block that lets it pass, so no pair counts twice and no pair has to leave its task: a task returns
each vector's number of links and a spanning forest of them. Large cells are dealt out in tiles.

Identical vectors of a label form one class, which is joined once with its number of rows.

Defined results: a null label, and vectors that are null, zero, or hold null or non-finite components, link with
nothing; vectors of unlike length never link; rows with equal ids are one node; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from interlog.llm.shared import Forest, components
from interlog.session import cut_lineage


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q


def bounds(dim: int, blocks: int) -> np.ndarray:
    """Where the blocks of a vector of ``dim`` components begin and end."""
    return np.unique(np.linspace(0, dim, min(blocks, dim) + 1).astype(int))


def rotated(x: np.ndarray) -> np.ndarray:
    """Unit vectors after the rotation, rounded so that every task sees the same numbers."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.round(x @ rotation(x.shape[1]), 9)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows whose vector is a point: (vec_id, x) with the components as bytes of doubles."""
    x = F.col(vec_col)
    good = (x.isNotNull() & (F.size(x) > 0)
            & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists(x, lambda v: v != 0))

    def as_bytes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(x=[np.asarray(v, "<f8").tobytes() for v in frame["x"]])

    others = [c for c in vectors.columns if c not in (id_col, vec_col)]
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = ", ".join(["vec_id long", "x binary", *(f"`{c}` {kinds[c]}" for c in others)])
    return vectors.where(F.coalesce(good, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), x.cast("array<double>").alias("x"), *others).mapInPandas(as_bytes, schema)


def cells_of(frame: pd.DataFrame, blocks: int, budget: float, width: float) -> pd.DataFrame:
    """A row for each block and cell that a vector lives in or visits."""
    out = []
    for dim, own in frame.groupby(frame["x"].str.len() // 8):
        y = rotated(np.frombuffer(b"".join(own["x"]), "<f8").reshape(len(own), dim))
        edges = bounds(dim, blocks)
        for b, (a, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            radius = np.sqrt(budget * (e - a) / dim) + 1e-6
            first = y[:, a]
            home = np.floor(first / width).astype(np.int64)
            low, high = np.floor((first - radius) / width).astype(np.int64), np.floor((first + radius) / width).astype(np.int64)
            n = high - low + 1
            row = np.repeat(np.arange(len(own)), n)
            cell = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            out.append(own.iloc[row].assign(block=b, cell=cell, home=cell == home[row]))
    columns = [*frame.columns, "block", "cell", "home"]
    return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)


def links_in(cell: pd.DataFrame, blocks: int, threshold: float, rows: int = 512) -> pd.DataFrame:
    """Links between a tile's visitors and residents: counts (b null) and forest edges (links 0)."""
    b = int(cell["block"].iloc[0])
    left, right = cell[cell["as_left"]], cell[~cell["as_left"]]
    if left.empty or right.empty:
        return pd.DataFrame({"a": [], "b": [], "links": []}).astype({"a": "int64", "b": "Int64", "links": "int64"})
    dim = len(left["x"].iloc[0]) // 8
    budget = 2 - 2 * threshold + 1e-9
    edges = bounds(dim, blocks)
    xl, xr = (np.frombuffer(b"".join(f["x"]), "<f8").reshape(len(f), dim) for f in (left, right))
    yl, yr = rotated(xl), rotated(xr)
    nl, nr = np.linalg.norm(xl, axis=1), np.linalg.norm(xr, axis=1)
    il, ir = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
    cl, cr = left["copies"].to_numpy(), right["copies"].to_numpy()
    s, e = edges[b], edges[b + 1]
    part = budget * np.diff(edges) / dim
    counts_l, counts_r = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    nodes, place = np.unique(np.concatenate([il, ir]), return_inverse=True)
    forest = Forest(len(nodes))
    sq = (yl[:, s:e] ** 2).sum(1)
    for at in range(0, len(right), rows):
        block = yr[at:at + rows, s:e]
        near = sq[:, None] + (block ** 2).sum(1) - 2 * yl[:, s:e] @ block.T <= part[b] + 1e-7
        near &= il[:, None] < ir[at:at + rows]
        us, vs = np.nonzero(near)
        for k in range(0, len(us), 1 << 17):                # pairs in bounded pieces
            u, v = us[k:k + (1 << 17)], vs[k:k + (1 << 17)] + at
            squares = np.add.reduceat((yl[u] - yr[v]) ** 2, edges[:-1], axis=1)
            passes = squares <= part
            first = passes[:, b] & ~passes[:, :b].any(1)
            u, v = u[first], v[first]
            cosine = np.einsum("ij,ij->i", xl[u], xr[v]) / (nl[u] * nr[v])
            u, v = u[cosine >= threshold], v[cosine >= threshold]
            if len(u):
                counts_l += np.bincount(u, cr[v], len(left)).astype(np.int64)
                counts_r += np.bincount(v, cl[u], len(right)).astype(np.int64)
                forest.join(place[u], place[len(left) + v])
    a, root = forest.edges()
    out = [pd.DataFrame({"a": ids[n > 0], "b": pd.array([pd.NA] * int((n > 0).sum()), "Int64"), "links": n[n > 0]})
           for ids, n in ((il, counts_l), (ir, counts_r))]
    out.append(pd.DataFrame({"a": nodes[a], "b": pd.array(nodes[root], "Int64"), "links": 0}))
    return pd.concat(out).astype({"a": "int64", "links": "int64"})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98, blocks: int = 8, width: float = 0.25, tile: int = 4000) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; a task holds at most about twice ``tile`` vectors."""
    budget = 2 - 2 * threshold + 1e-9
    slim = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"), F.col(label_col).cast("string").alias("label"))
    points = usable(slim.where("label is not null and vec_id is not null"), "vec_id", "v")
    points = cut_lineage(points.withColumn("digest", F.unhex(F.md5("x"))), "vectors")
    classes = cut_lineage(points.groupBy("label", "digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("x").alias("x")), "vector_classes")
    placed = classes.select(F.col("rep").alias("vec_id"), "label", "copies", "x").mapInPandas(
        lambda frames: (cells_of(f, blocks, budget, width) for f in frames),
        "vec_id long, label string, copies long, x binary, block int, cell long, home boolean")
    placed = cut_lineage(placed.withColumn("dim", F.length("x")), "vector_cells")
    key = ["label", "dim", "block", "cell"]
    tiles = placed.groupBy(key).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("tiles")).cast("int")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    dealt = placed.join(tiles, key).withColumn("mine", mine)
    one = dealt.withColumn("as_left", F.lit(True)).withColumn("j", F.explode(every)).withColumn("i", F.col("mine"))
    two = dealt.where("home").withColumn("as_left", F.lit(False)).withColumn("i", F.explode(every)).withColumn("j", F.col("mine"))
    columns = [*key, "i", "j", "as_left", "vec_id", "copies", "x"]
    found = one.select(columns).union(two.select(columns)).groupBy(*key, "i", "j").applyInPandas(
        lambda cell: links_in(cell, blocks, threshold), "a long, b long, links long")
    found = cut_lineage(found, "vector_links")
    counts = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null"), name="vector_components")
    own = (classes.select("label", "digest", "rep", "copies").join(counts, "rep", "left")
           .join(roots, F.col("rep") == F.col("node"), "left")
           .select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                   F.coalesce("root", "rep").alias("component")))
    linked = points.select("vec_id", "label", "digest").join(own, ["label", "digest"]).select("vec_id", "n_links", "component")
    apart = points.select("vec_id").union(slim.where("false").select("vec_id"))
    rest = slim.select("vec_id", "label", "v").join(apart.distinct(), "vec_id", "left_anti").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component"))
    return linked.union(rest).select("vec_id", "n_links", F.col("component").alias("component_id"),
                                     F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"))
