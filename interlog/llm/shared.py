"""Helpers of this subpackage: table reads, byte views of Arrow text and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from interlog.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python a thousand at a time, which bounds a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores put before it until it differs from all ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lower_ascii(col):
    """A-Z in lower case; other letters stay. Pure ASCII text takes the faster way."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows, without making Python strings."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int):
    """Row ranges of about ``most`` bytes; a longer row is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(node, root) of every node with a link; ``root`` is the smallest node that links reach.

    Rounds of large-star and small-star steps: each node's larger neighbours move to its smallest one, then
    its smaller neighbours do. Every round is written to the checkpoint folder, so a lost executor costs no
    more than a round, and rounds are logarithmic in the longest path. Hot nodes are safe: both steps are a
    minimum per node, which sums before the shuffle, and an equi-join.
    """
    edges = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
                        name)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut_lineage(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u <> v").distinct(), name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        stars = cut_lineage(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .union(least.select("u", F.col("m").alias("v"))).distinct(), name)
        same = (stars.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
                == edges.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first())
        edges = stars
        if same:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


class Forest:
    """Components of the rows of one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        self._flatten()
        pairs = np.unique(np.column_stack([self.parent[u], self.parent[v]]), axis=0)
        parent = self.parent
        for a, b in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)

    def _flatten(self) -> None:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return
            self.parent = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        self._flatten()
        nodes = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return nodes, self.parent[nodes]


class Hashes:
    """64-bit hashes of byte ranges: a table value per byte times powers of an odd base, summed by prefix sums."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 64, 256, np.uint64)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            n = len(data) + (1 << 16)
            up, down = np.full(n, self.base), np.full(n, self.inverse)
            up[0] = down[0] = 1
            self.powers, self.inverses = np.cumprod(up), np.cumprod(down)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:len(data)], out=sums[1:])
        return sums

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((prefix[ends] - prefix[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ASCII white space; a row's end also ends a run."""
    solid = ~SPACES[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True                                   # rows start anew
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends
