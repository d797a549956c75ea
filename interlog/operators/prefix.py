"""Skew-safe building blocks for "strictly before" (PRIOR) statistics.

A window partitioned by user puts a user's whole history into one task; one very active key would then
hold up the stage. These helpers split every key's order axis into chunks, so the work per task is bounded
by the chunk size, not by the size of the hottest key:

* ``prior_totals``: per (keys, order) the sums over rows with a strictly smaller order value.
  Rows are first pre-aggregated to one row per (keys, order) (partial aggregation before the shuffle),
  then prefix sums are taken inside (keys, chunk) and offset by the totals of earlier chunks.
* ``with_prior_sums``: the same sums as columns on the rows themselves, for several key lists at once: rows move once,
  by (leading keys, chunk), and totals of earlier chunks come in as rows of their own instead of joins.
* ``dense_rank0``: 0-based dense rank = number of distinct smaller order values (same two levels).
* ``halo_chunks``: for sliding frames that look back at most ``halo`` units, rows are partitioned by
  (keys, chunk) and the tail of each chunk is copied into the next one as read-only context.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
OWN = "_own"


def _chunk(order: str, chunk_size: float):
    return F.floor(F.col(order) / F.lit(chunk_size))


def _prefix_over_groups(per: DataFrame, keys: Sequence[str], order: str, names: Sequence[str],
                        chunk_size: float) -> DataFrame:
    """``per`` has one row per (keys, order) and a ``_chunk`` column, hash-partitioned on (keys, chunk):
    chunk totals and the within-chunk window then need no further exchange."""
    totals = per.groupBy(*keys, CHUNK).agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, CHUNK, *[
        F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_o_{n}") for n in names])
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = per.select(*keys, order, CHUNK, *[F.sum(n).over(inside).alias(f"_i_{n}") for n in names])
    return within.join(offsets, [*keys, CHUNK]).select(
        *keys, order, *[(F.coalesce(F.col(f"_i_{n}"), F.lit(0)) + F.col(f"_o_{n}")).alias(n) for n in names])


def prior_totals(df: DataFrame, keys: Sequence[str], order: str, values: Mapping[str, Column],
                 chunk_size: float = 4096) -> DataFrame:
    """One row per (keys, order): ``name = coalesce(sum(value) over rows with a smaller order, 0)``.

    Rows with a null ``order`` are ignored. Keys must be non-null.
    """
    names = list(values)
    per = (df.where(F.col(order).isNotNull()).withColumn(CHUNK, _chunk(order, chunk_size))
             .repartition(*keys, CHUNK)
             .groupBy(*keys, CHUNK, order).agg(*[F.sum(c).alias(n) for n, c in values.items()]))
    return _prefix_over_groups(per, keys, order, names, chunk_size)


def several_chunks(df: DataFrame, order: str, chunk_size: float) -> Column:
    """True if the table spans more than one chunk (a scalar subquery): else nothing needs carrying."""
    chunk = _chunk(order, chunk_size)
    return df.select((F.max(chunk) > F.min(chunk)).alias("_several")).scalar()


def with_prior_sums(df: DataFrame, by: Sequence[str], order: str, families: Sequence[tuple[Sequence[str], Mapping[str, Column]]],
                    chunk_size: int = 4096, several: Column | None = None) -> DataFrame:
    """``df`` with ``name`` = the sum of ``value`` over the rows with the same keys and a smaller integer ``order`` (0 if
    none, null on rows with a null key or order), for each (keys, {name: value}) of ``families``.

    Every key list begins with ``by``. Rows are dealt by (``by``, chunk) once; each key list's totals of earlier chunks
    enter the chunk as a row before its first, and only where the table spans several chunks (``several``, where that is
    known from an earlier table; it may be true without need)."""
    chunk = _chunk(order, chunk_size)
    several = several_chunks(df, order, chunk_size) if several is None else several
    width = max(len(values) for _, values in families)
    rows = df.withColumn(CHUNK, chunk)
    slots = [f"_c{i}" for i in range(width)]
    union = rows.withColumn("_family", F.lit(None).cast("int"))
    types = {}
    for f, (keys, values) in enumerate(families):
        known = rows.where(several).dropna(subset=[*keys, order])
        totals = known.groupBy(*keys, CHUNK).agg(*[F.sum(v).alias(c) for c, v in zip(slots, values.values())])
        types |= {(f, c): totals.schema[c].dataType for c in slots[:len(values)]}
        ahead = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(*keys, CHUNK, *[F.sum(c).over(ahead).alias(c) for c in slots[:len(values)]],
                                F.row_number().over(Window.partitionBy(*keys).orderBy(CHUNK)).alias("_n")).where("_n > 1").drop("_n")
        union = union.unionByName(carried.withColumns({order: (F.col(CHUNK) * chunk_size - 1).cast(df.schema[order].dataType),
                                                       "_family": F.lit(f)}), allowMissingColumns=True)
    out = union.repartition(*by, CHUNK)
    real = F.col("_family").isNull()
    names = []
    for f, (keys, values) in enumerate(families):
        before = Window.partitionBy(*dict.fromkeys([*by, CHUNK, *keys])).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
        held = real
        for k in (*keys, order):
            held = held & F.col(k).isNotNull()
        sums = {n: F.sum(F.when(real, v).when(F.col("_family") == f, F.col(c).cast(types[f, c]))).over(before)
                for (n, v), c in zip(values.items(), slots)}
        out = out.withColumns({n: F.when(held, F.coalesce(x, F.lit(0))) for n, x in sums.items()})
        names += values
    return out.where(real).select(*df.columns, *names)


def prior_extreme(df: DataFrame, keys: Sequence[str], order: str, values: Mapping[str, Column],
                  how: str = "min", chunk_size: float = 4096) -> DataFrame:
    """One row per (keys, order): ``name`` = min (or max) of ``value`` over rows of the same keys with a
    strictly smaller order; null when there are none. Same two levels as ``prior_totals``."""
    agg = {"min": F.min, "max": F.max}[how]
    comb = {"min": F.least, "max": F.greatest}[how]
    names = list(values)
    per = (df.where(F.col(order).isNotNull()).withColumn(CHUNK, _chunk(order, chunk_size))
             .repartition(*keys, CHUNK)
             .groupBy(*keys, CHUNK, order).agg(*[agg(c).alias(n) for n, c in values.items()]))
    totals = per.groupBy(*keys, CHUNK).agg(*[agg(n).alias(n) for n in names])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, CHUNK, *[agg(n).over(earlier).alias(f"_o_{n}") for n in names])
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = per.select(*keys, order, CHUNK, *[agg(n).over(inside).alias(f"_i_{n}") for n in names])
    # least / greatest skip nulls, so an empty side does not hide the other
    return within.join(offsets, [*keys, CHUNK]).select(
        *keys, order, *[comb(F.col(f"_i_{n}"), F.col(f"_o_{n}")).alias(n) for n in names])


def dense_rank0(df: DataFrame, keys: Sequence[str], order: str, name: str,
                chunk_size: float) -> DataFrame:
    """One row per distinct (keys, order): ``name`` = number of distinct smaller order values."""
    per = (df.select(*keys, order).where(F.col(order).isNotNull()).withColumn(CHUNK, _chunk(order, chunk_size))
             .repartition(*keys, CHUNK).distinct().withColumn(name, F.lit(1).cast("long")))
    return _prefix_over_groups(per, keys, order, [name], chunk_size)


def halo_chunks(df: DataFrame, order: str, chunk_size: int, halo: int) -> DataFrame:
    """Add ``_chunk`` and ``_own``; rows within ``halo`` of the next chunk are also copied there.

    A window partitioned by (keys, ``_chunk``) whose frame looks back at most ``halo`` order units
    gives exact results on the rows with ``_own`` true. Requires ``0 <= halo <= chunk_size``.
    """
    if not 0 <= halo <= chunk_size:
        raise ValueError("halo must lie in [0, chunk_size]")
    own = (df.withColumn(CHUNK, F.floor(F.col(order) / F.lit(chunk_size)))
             .withColumn(OWN, F.lit(True)))
    if halo == 0:
        return own
    ctx = (own.where(F.col(order) - F.col(CHUNK) * chunk_size >= chunk_size - halo)
              .withColumn(CHUNK, F.col(CHUNK) + 1).withColumn(OWN, F.lit(False)))
    return own.unionByName(ctx)
