"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its distinct word shingles; its sketch is the ``k`` smallest.
Documents with equal sets form one class and only the class's smallest id goes on. Inverted lists hold the
``posted`` smallest values, posted as runs of three successive ones, so a passage that many documents share
makes no hot list. Two sets that link and have at most ``posted`` values in their union always share such a run
(their few differences cannot cut all runs); beyond that the chance of sharing none is under 1e-7 a pair.

Pairs of a list are met in rounds: first every member with the list's first pivot, then with the next three.
After each round linked documents are merged, and lists whose members are all in one component are done, so
a large group of copies costs a few pairs a member. The lists that still hold several components then meet
whole inside tasks: lists with the same first pivot are one if they fit into a tile, a longer list is dealt
out in tiles, a task compares two tiles, and only a forest of the links it found leaves it, never pairs.
Of lists with the same members one is kept. Pairs are kept by size, then
by the similarity that the union's sketch estimates, and confirmed on the full sets.

Defined results: a null or empty text has an empty set and links with nothing; fewer words than a shingle make
one shingle of them all; rows with equal ids are one document; a null id is never linked; an empty table gives
no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from interlog.llm.shared import TO_LOWER, Forest, Hashes, components, mixed, slices, utf8, words
from interlog.session import cut_lineage

HASHES = Hashes()
RANGE = 1 << 20                 # bytes of text worked on at once
TILE = 1 << 18                  # set values of one tile of a list, a set counting as 128 at least
CELLS = 1 << 22                 # cells of a table of sets by values that is filled at once
SMALL = 500_000                 # ids that a broadcast may hold; more are joined by a shuffle
SEED2 = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (signed) of every row; A-Z count as lower case."""
    data = TO_LOWER[data]
    starts, ends = words(data, offsets)
    own = HASHES.ranges(HASHES.prefix(data), starts, ends)
    bounds = np.searchsorted(starts, offsets)
    place = [HASHES.values[k] | np.uint64(1) for k in range(width)]
    runs = np.zeros(len(own), np.uint64)
    for k in range(width):
        runs[:len(own) - k] += own[k:] * place[k]
    runs = mixed(runs).view(np.int64)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a:b - width + 1]))
        elif b > a:
            short = sum((own[a + k] * place[k] for k in range(b - a)), np.uint64(b - a))
            out.append(mixed(np.array([short], np.uint64)).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, k: int) -> DataFrame:
    """(doc_id, n, digest, low): set size, 128 bits that stand for the set, and its k smallest values."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            with np.errstate(over="ignore"):
                digest = [mixed(np.array([x.view(np.uint64).sum(), mixed(x.view(np.uint64) ^ SEED2).sum()]) + np.uint64(len(x))).tobytes()
                          for x in sets]
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(x) for x in sets], pa.int64()), pa.array(digest, pa.binary()),
                                              _lists([x[:k] for x in sets])], names=["doc_id", "n", "digest", "low"])

    return _texts(docs, id_col, text_col).mapInArrow(described, "doc_id long, n long, digest binary, low array<long>")


def whole_sets(texts: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, own): the full sets of the named documents, made anew from their texts."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays([keys, pa.array([len(x) for x in sets], pa.int64()), _lists(sets)],
                                             names=["doc_id", "n", "own"])

    return only(texts, ids).mapInArrow(described, "doc_id long, n long, own array<long>")


def only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows with one of the ids (a written table); few ids go to every task, which spares a shuffle of all rows."""
    return rows.join(F.broadcast(ids) if ids.count() <= SMALL else ids, "doc_id", "left_semi")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for at, to in slices(offsets, RANGE):
            with np.errstate(over="ignore"):
                sets = shingle_sets(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], width)
            yield batch.column(0).slice(at, to - at), sets


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def postings(reps: DataFrame, posted: int) -> DataFrame:
    """(key, doc_id, n): a row for each run of three successive low values; runs of two for sets of 4 or 5."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            low = batch.column(2)
            bounds, values = np.asarray(low.offsets).astype(np.int64), np.asarray(low.values).view(np.uint64)
            count = np.minimum(np.diff(bounds), posted)
            with np.errstate(over="ignore"):
                for span, some in ((3, count >= 3), (2, (sizes == 4) | (sizes == 5))):
                    n = np.where(some, count - span + 1, 0)
                    row = np.repeat(np.arange(len(ids)), n)
                    at = bounds[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    key = np.full(len(row), span, np.uint64)
                    for j in range(span):
                        key = mixed(key * np.uint64(31) + values[at + j])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[row]), pa.array(sizes[row])],
                                                     names=["key", "doc_id", "n"])

    return reps.mapInArrow(runs, "key long, doc_id long, n long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
                k: int = 64, posted: int = 48, least_estimate: float = 0.5, tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    ``percent`` of the union that two linked sets share at least; ``component_id`` is the smallest id that
    links reach and ``kept`` marks the documents that have it.
    """
    every = cut_lineage(sketches(docs, id_col, text_col, width, k), "sketches")
    classes = cut_lineage(every.where("n > 0 and doc_id is not null").groupBy("digest", "n")
                          .agg(F.min("doc_id").alias("rep")), "sketch_classes")
    reps = only(every.select("doc_id", "n", "low"), classes.select(F.col("rep").alias("doc_id")))
    by_key = Window.partitionBy("key")
    in_order = by_key.orderBy(F.xxhash64("doc_id"), "doc_id")
    lists = (postings(reps, posted).withColumn("members", F.count("*").over(by_key)).where("members > 1")
             .withColumn("place", F.row_number().over(in_order)).withColumn("pivot", F.first("doc_id").over(in_order)).drop("members"))
    lists = cut_lineage(lists, "sketch_lists")
    lists = cut_lineage(lists.join(different(lists), "key", "left_semi"), "sketch_lists")
    roots = linked(lists, every, _texts(docs, id_col, text_col), width, percent, k, least_estimate, tile)
    member = classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        "digest", "n", F.coalesce("root", "rep").alias("component"))
    return (every.select("doc_id", "n", "digest").join(member, ["digest", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def different(lists: DataFrame) -> DataFrame:
    """One key of those whose lists have the same members (by their number and 128 bits of hashes): copies of a text or
    a passage share most of their keys, and one list of them finds all their links."""
    marks = [F.bit_xor(F.xxhash64(F.col("doc_id"), F.lit(salt))) for salt in (1, 2)]
    same = lists.groupBy("key").agg(F.count("*").alias("members"), marks[0].alias("x"), marks[1].alias("y"))
    return same.groupBy("members", "x", "y").agg(F.min("key").alias("key")).select("key")


def linked(lists: DataFrame, every: DataFrame, texts: DataFrame, width: int, percent: int, k: int,
           least_estimate: float, tile: int = TILE) -> DataFrame:
    """(node, root) of all documents with a confirmed link."""
    spark = lists.sparkSession
    roots = spark.createDataFrame([], "node long, root long")
    tested = spark.createDataFrame([], "a long, b long")
    for low, high in ((0, 1), (1, 4)):
        mine = still_open(lists, roots, low + 1)
        pivot = mine.where((F.col("place") > low) & (F.col("place") <= high)).select(
            "key", *(F.col(c).alias(f"p_{c}") for c in ("doc_id", "n", "place", "root")))
        met = mine.join(pivot, "key").where(
            (F.col("place") > F.col("p_place")) & (F.col("root") != F.col("p_root"))
            & (F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * percent)).select(
            F.least("doc_id", "p_doc_id").alias("a"), F.greatest("doc_id", "p_doc_id").alias("b"))
        pairs = cut_lineage(met.distinct().join(tested, ["a", "b"], "left_anti"), "sketch_pairs")
        links = cut_lineage(confirmed(pairs, every, texts, width, percent, k, least_estimate), "links")
        roots = merged(roots, links)
        tested, lists = pairs, mine.drop("root")
    return merged(roots, met_in_tasks(still_open(lists, roots, high), texts, width, percent, k, least_estimate, tile))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    if links.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links), name="copies")


def still_open(lists: DataFrame, roots: DataFrame, met: int) -> DataFrame:
    """Lists, each member with its component, that hold several components and members beyond those that all have met."""
    mine = lists.join(roots, F.col("doc_id") == F.col("node"), "left").select(
        "key", "pivot", "doc_id", "n", "place", F.coalesce("root", "doc_id").alias("root"))
    split = (mine.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.max("place").alias("last"))
             .where((F.col("x") < F.col("y")) & (F.col("last") > met)).select("key"))
    return cut_lineage(mine.join(split, "key", "left_semi"), "open_lists")


def met_in_tasks(mine: DataFrame, texts: DataFrame, width: int, percent: int, k: int,
                 least_estimate: float, tile: int = TILE) -> DataFrame:
    """(a, b): forests of the confirmed links between members of a list; a task holds two tiles of one list."""
    whole = whole_sets(texts, cut_lineage(mine.select("doc_id").distinct(), "open_ids"), width).select("doc_id", "own")
    whole = cut_lineage(whole, "open_sets")
    found = dealt(gathered(mine, tile), tile).join(whole, "doc_id").groupBy("key", "i", "j").applyInArrow(
        lambda cell: links_in(cell, percent, k, least_estimate), "a long, b long")
    return cut_lineage(found.distinct(), "links")


def gathered(mine: DataFrame, tile: int) -> DataFrame:
    """The lists with the same first pivot as one list, if all their members fit into a tile: near texts share many lists,
    and so a full set goes once to its pivot's task, not once for each list. Longer ones stay as they are."""
    once = mine.select("pivot", "doc_id", "n", "root").distinct()
    long = (once.groupBy("pivot").agg(F.sum(F.greatest("n", F.lit(128))).alias("values"))
            .where(F.col("values") > tile).select("pivot"))             # few, as each has more values than a tile
    long = F.broadcast(cut_lineage(long, "long_groups"))
    lists = once.join(long, "pivot", "left_anti").select(F.col("pivot").alias("key"), "doc_id", "n", "root")
    return cut_lineage(lists.union(mine.join(long, "pivot", "left_semi").select("key", "doc_id", "n", "root")), "open_groups")


def dealt(mine: DataFrame, tile: int) -> DataFrame:
    """The members of each list once for every cell (two tiles, or a tile with itself) that they stand in."""
    tiles = mine.groupBy("key").agg(F.ceil(F.sum(F.greatest("n", F.lit(128))) / tile).cast("int").alias("tiles"))
    return (mine.join(tiles, "key").withColumn("t", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int"))
            .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("key", F.least("t", "s").alias("i"), F.greatest("t", "s").alias("j"),
                    (F.col("t") <= F.col("s")).alias("as_left"), "doc_id", "n", "root"))


def candidates(cell: pa.Table, percent: int, k: int, least_estimate: float) -> tuple:
    """Left rows, right rows, which of their pairs the sizes and the sketches (an upper bound of the estimate) let pass,
    and the rows' values."""
    sizes, roots, as_left = (np.asarray(cell.column(c)) for c in ("n", "root", "as_left"))
    own = cell.column("own").combine_chunks()
    held = np.asarray(own.value_lengths()).astype(np.int64)
    values = np.asarray(own.flatten())
    one = as_left.all()
    u = np.flatnonzero(as_left)
    v = u if one else np.flatnonzero(~as_left)
    small, large = np.minimum.outer(sizes[u], sizes[v]), np.maximum.outer(sizes[u], sizes[v])
    near = (small * 100 >= large * percent) & (roots[u][:, None] != roots[v])
    if one:
        near = np.triu(near, 1)
    u, v, near = _left(u, v, near)
    if near.any():
        low = np.minimum(sizes, k)
        common = shared_values(values, held, u, v, k)
        near &= common >= np.minimum(k, low[u][:, None] + low[v] - common) * least_estimate
        u, v, near = _left(u, v, near)
    return u, v, near, (values, held)


def _left(u: np.ndarray, v: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, columns = near.any(1), near.any(0)
    return u[rows], v[columns], near[np.ix_(rows, columns)]


def links_in(cell: pa.Table, percent: int, k: int, least_estimate: float) -> pa.Table:
    """A forest of the links between the left and the right rows (or among the left, where there are no others)."""
    ids, sizes = np.asarray(cell.column("doc_id")), np.asarray(cell.column("n"))
    u, v, near, (values, held) = candidates(cell, percent, k, least_estimate)
    if near.any():
        common = shared_values(values, held, u, v, None)
        near &= common * 100 >= (sizes[u][:, None] + sizes[v] - common) * percent
    forest = Forest(len(ids))
    x, y = np.nonzero(near)
    if len(x):
        forest.join(u[x], v[y])
    node, parent = forest.edges()
    return pa.table({"a": ids[node], "b": ids[parent]})


def shared_values(values: np.ndarray, sizes: np.ndarray, u: np.ndarray, v: np.ndarray, most: int | None) -> np.ndarray:
    """How many values the sets of rows ``u`` (down) and ``v`` (across) share, of their ``most`` smallest each."""
    starts = np.cumsum(sizes) - sizes
    rows = np.concatenate([u, v])
    n = np.minimum(sizes[rows], most) if most else sizes[rows]
    row = np.repeat(np.arange(len(rows)), n)
    place = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(len(row))
    _, code, count = np.unique(values[place], return_inverse=True, return_counts=True)
    often = count > 1
    row, code = row[often[code]], (np.cumsum(often) - 1)[code[often[code]]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(u), len(v)), np.float32)
    step = max(1, CELLS // len(rows))
    for at in range(0, int(often.sum()), step):
        a, b = np.searchsorted(code, [at, at + step])
        table = np.zeros((len(rows), step), np.float32)
        table[row[a:b], code[a:b] - at] = 1
        out += table[:len(u)] @ table[len(u):].T
    return out.astype(np.int64)


def ids_of(pairs: DataFrame, name: str) -> DataFrame:
    ends = [pairs.select(F.col(c).alias("doc_id")).distinct() for c in ("a", "b")]
    return cut_lineage(ends[0].union(ends[1]).distinct(), name)


def confirmed(pairs: DataFrame, every: DataFrame, texts: DataFrame, width: int, percent: int, k: int,
              least_estimate: float) -> DataFrame:
    """The pairs that the union's sketch lets pass and the full sets confirm."""
    low = only(every.select("doc_id", "low"), ids_of(pairs, "pair_ids"))
    both = (pairs.join(low.withColumnsRenamed({"doc_id": "a", "low": "low_a"}), "a")
            .join(low.withColumnsRenamed({"doc_id": "b", "low": "low_b"}), "b"))
    union = F.slice(F.array_sort(F.array_union("low_a", "low_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("low_a", "low_b")))
    likely = cut_lineage(both.where(shared >= F.size(union) * least_estimate).select("a", "b").distinct(), "likely")
    whole = cut_lineage(whole_sets(texts, ids_of(likely, "likely_ids"), width), "whole_sets")
    sets = (likely.join(whole.withColumnsRenamed({"doc_id": "a", "n": "n_a", "own": "own_a"}), "a")
            .join(whole.withColumnsRenamed({"doc_id": "b", "n": "n_b", "own": "own_b"}), "b"))
    common = F.size(F.array_intersect("own_a", "own_b"))
    return sets.where(common * 100 >= (F.col("n_a") + F.col("n_b") - common) * percent).select("a", "b").distinct()


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near copies (the smallest id) and of each repeated id."""
    removed = near_copies(docs, id_col, text_col, **options).where(~F.col("kept")).select("doc_id").distinct()
    removed = cut_lineage(removed, "copies_removed")
    repeated = cut_lineage(docs.groupBy(F.col(id_col).alias("doc_id")).count().where("count > 1 and doc_id is not null")
                           .select("doc_id"), "ids_repeated")
    removed, repeated = (x.withColumnRenamed("doc_id", id_col) for x in (removed, repeated))
    once = docs.join(removed.union(repeated), id_col, "left_anti")
    return once.union(docs.join(repeated, id_col, "left_semi").join(removed, id_col, "left_anti").dropDuplicates([id_col]))
