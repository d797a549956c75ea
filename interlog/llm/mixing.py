"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Targets: sources in code point order weigh 5, 2, 1 and so on, and share a part of all words; a source's
target stops at ``repeats`` times its size and what it leaves is shared again by weight (the level to
which all other sources fill is found from prefix sums over the source table).

Queue: a source's documents are shuffled by a keyed hash. A copy's virtual finish time is the number of
its source's words up to its end divided by the target; copies are taken in order of that time while the
budget lasts. Running sums go over bounded hash ranges of a source plus the ranges' offsets, and the
end of the budget is found by narrowing time ranges, so no task holds a whole source.

Defined results: a null text has size 0 and is never taken, null sources form one source that comes last,
each repeated row counts, ties follow the hash and then the row, an empty table gives no rows. The
operator reads the named columns only, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from interlog.llm.shared import unused
from interlog.session import cut_lineage

BETWEEN = r"[\x20\x09-\x0D]+"
STEPS = 1024                     # time ranges per narrowing


def shuffled(key: Column, seed: str) -> Column:
    """60 bits that order documents at random but alike in every run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), 1, 15),
                  16, 10).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, repeats: int, rows: int) -> DataFrame:
    """One row per source: its rank, size, target and number of hash ranges."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = per.withColumn("rank", F.row_number().over(order)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * repeats
    fills = Window.orderBy(cap / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (per.withColumn("cap", cap)
           .withColumn("left", F.sum("source_size").over(everything) * share
                       - F.coalesce(F.sum("cap").over(fills), F.lit(0)))
           .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fills), F.lit(0)))
           .withColumn("level", F.col("left") / F.col("open")))
    # the first source, by the level at which it is full, that its share does not fill
    short = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    first = F.min_by(short, F.when(short.isNotNull(), F.struct(F.col("cap") / F.col("weight"), F.col("rank"))))
    return (per.withColumn("fill", first.over(everything))
            .withColumn("target", F.least(F.col("cap").cast("double"),
                                          F.coalesce(F.col("fill") * F.col("weight"), F.col("cap").cast("double"))))
            .select("source", "rank", "source_size", "target",
                    F.greatest(F.lit(1), F.ceil(F.col("n") / rows)).cast("long").alias("ranges")))


def queue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: str = "mix",
          rows: int = 5_000) -> DataFrame:
    """Every document with its size, its source's size and target, and ``taken``, the words the mix takes.

    ``share`` is the budget as a part of all words, ``rows`` the expected documents of a hash range.
    """
    size = F.greatest(F.size(F.array_remove(F.split(F.col(text_col), BETWEEN, -1), "")), F.lit(0)).cast("long")
    sized = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
        F.xxhash64(F.col(text_col)).alias("text_hash"), shuffled(F.col(id_col), seed).alias("place")), "mix_sizes")
    targets = cut_lineage(source_targets(sized, weights, share, repeats, rows).coalesce(1), "mix_targets")
    ranged = (sized.join(targets.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own"))).drop("own")
              .withColumn("range", F.floor(F.col("place") / (F.lit(float(1 << 60)) / F.col("ranges")))))
    before = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("rank", "range").agg(F.sum("size").alias("words"))
               .select("rank", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")))
    upto = (Window.partitionBy("rank", "range").orderBy("place", "doc_id", "text_hash", "size")
            .rowsBetween(Window.unboundedPreceding, 0))
    ends = (ranged.withColumn("end", F.sum("size").over(upto)).join(offsets, ["rank", "range"])
            .withColumn("end", F.col("end") + F.col("offset")).drop("offset", "ranges", "range"))
    ends = cut_lineage(ends, "mix_ends")
    copies = [finish_time(k) for k in range(repeats)]
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    last = last_taken(ends.where("size > 0").select("rank", "size", F.explode(F.array(*copies)).alias("time")), budget)
    taken = sum((F.when(_not_after(t, F.col("rank"), last), F.col("size")).otherwise(0) for t in copies), F.lit(0))
    return ends.select("doc_id", "source", "text_hash", "size", "source_size", "target", taken.cast("long").alias("taken"))


def finish_time(copy: int) -> Column:
    return F.try_divide((F.col("source_size") * copy + F.col("end")).cast("double"), F.col("target"))


def _not_after(time: Column, rank: Column, last: tuple | None) -> Column:
    if last is None:
        return F.lit(False)
    return F.coalesce((time < last[0]) | ((time == last[0]) & (rank <= last[1])), F.lit(False))


def last_taken(copies: DataFrame, budget: float) -> tuple | None:
    """(time, rank) of the last copy that the budget holds: ranges of time narrow until few copies are left."""
    low, width, used = 0.0, 1.0 / 16, 0
    rest = copies
    for _ in range(3):
        step = F.least(F.floor((F.col("time") - low) / width), F.lit(STEPS - 1)).cast("long")
        running = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
        upto = (rest.groupBy(step.alias("step")).agg(F.sum("size").alias("words"))
                .select("step", "words", (F.sum("words").over(running) + used).alias("upto")))
        cross = upto.where(F.col("upto") > budget).orderBy("step").first()
        if cross is None:
            break
        used = cross["upto"] - cross["words"]
        rest = rest.where(step == cross["step"])
        if cross["step"] == STEPS - 1:
            break
        low, width = low + cross["step"] * width, width / STEPS
    if cross is None:
        end = rest.agg(F.max(F.struct("time", "rank")).alias("x")).first()["x"]
        return tuple(end) if end is not None else None
    running = Window.orderBy("time", "rank").rowsBetween(Window.unboundedPreceding, 0)
    inside = (rest.withColumn("upto", F.sum("size").over(running) + used).where(F.col("upto") <= budget)
              .agg(F.max(F.struct("time", "rank")).alias("x")).first()["x"])
    if inside is not None:
        return tuple(inside)
    first = rest.agg(F.min(F.struct("time", "rank")).alias("x")).first()["x"]
    return first[0], first[1] - 1


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed rows themselves: a document comes once for each copy the mix takes."""
    keys = [unused(docs.columns, c) for c in ("_mix_id", "_mix_text", "_mix_source", "_mix_none")]
    copies, copy = unused(docs.columns, "_mix_copies"), unused(docs.columns, "_mix_copy")
    decided = (queue(docs, id_col, text_col, source_col, **options)
               .groupBy(*_row_key(F.col("doc_id"), F.col("text_hash"), F.col("source"), keys))
               .agg(F.sum(F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)).alias(copies))
               .where(F.col(copies) > 0))
    keyed = docs.select(*[docs[c] for c in docs.columns], *_row_key(docs[id_col], F.xxhash64(docs[text_col]), docs[source_col], keys))
    own = keyed.dropDuplicates(keys)       # identical rows are one document with that many more copies
    return (own.join(decided, keys)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns))


def _row_key(key: Column, text_hash: Column, source: Column, names: list[str]) -> list[Column]:
    """What tells rows apart, without nulls."""
    parts = [F.coalesce(key.cast("string"), F.lit("")), text_hash, F.coalesce(source, F.lit("")), source.isNull()]
    return [part.alias(name) for part, name in zip(parts, names, strict=True)]
