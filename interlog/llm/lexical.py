"""Ranked lexical search: every posting list cut into blocks of similar documents with exact summary bounds.

The documents are read once into a forward table of the terms that a batch of items asks for, with each
document's length. Segments of that table are searched independently. In a segment every term's posting list is
clustered by document similarity (random projections of the documents' weighted terms, nearest of evenly drawn
representatives) and the clusters are cut into blocks. A block's summary is the coordinatewise maximum of its
documents over the terms that items ask for together with the list's term.

An item's terms are ordered by falling weight and a document is met in the list of its first term in that
order, so a block's bound for an item is the summed maxima of the list's term and those after it. A block is
skipped only if its bound lies below the item's threshold, a whole list only if the largest weights of its
term and those after it do. Thresholds are tenth-best exact scores of documents that hold the item's rarest
terms, so they never exceed the true tenth-best score: no document of the result is skipped. Documents of the
other blocks are scored in full.

Scale: no postings are shuffled. What leaves a segment are documents at or above their item's threshold, at
most ``k`` an item; the final ranking keeps ``k`` an item before its shuffle too. Segments hold at most 4,096
documents and at most 16 million cells. Items are taken in batches of about 256, one pass over the forward
table each, so only a batch's terms travel to the tasks; a task holds one item's distinct terms at least.

Defined results: null and empty texts hold no terms and are not counted in N; repeated rows of documents rank
one by one; rows of items with one id are one item with all their terms; null ids of items form one item, null
ids of documents come last among ties; items without terms and empty tables give no rows; other columns are
not read, so extra columns cannot clash. Very long texts are split into slices of about a megabyte.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from interlog.session import cut_lineage

#: Bytes outside terms become blanks, A-Z become lower case; bytes of letters beyond ASCII stay.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SEGMENT, CELLS, BLOCK, SEEDS, SLICE = 4096, 16_000_000, 16, 2000, 1 << 20


def term_slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice."""
    spelled, at = text.translate(TERM_BYTES), 0
    while len(spelled) - at > SLICE:
        to = spelled.find(b" ", at + SLICE)
        if to < 0:
            break
        yield spelled[at:to].split()
        at = to
    yield spelled[at:].split()


def _forward(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            keys, texts = batch.slice(start, 1000).columns
            sizes, terms, counts, ends = [], [], [], [0]
            for text in texts:
                n, found = 0, []
                for words in term_slices(text.as_py() or b""):
                    n += len(words)
                    found.append(np.array([i for i in map(vocabulary.get, words) if i is not None], np.int32))
                ids, times = np.unique(np.concatenate(found), return_counts=True)
                sizes.append(n)
                terms.append(ids)
                counts.append(times)
                ends.append(ends[-1] + len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), pa.int32())) for parts in (terms, counts)]
            yield pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])


class Batch:
    """Items of one batch: their terms by falling weight, as numbers of the batch's vocabulary."""

    def __init__(self, items: dict, vocabulary: dict[bytes, int], df: np.ndarray, documents: int, total: int):
        self.documents, self.total = documents, total
        self.weights = np.array([floor(1000 * log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        order = np.lexsort((np.arange(len(df)), df))                  # rarest first, that is by falling weight
        place = np.empty(len(df), np.int64)
        place[order] = np.arange(len(df))
        self.terms = {item: np.array(sorted((vocabulary[t] for t in terms), key=place.__getitem__), np.int64) for item, terms in items.items()}
        self.df = df

    def seeds(self, item) -> tuple[np.ndarray, int]:
        """The rarest terms that together hold ``SEEDS`` documents or more, and of how many of these one is scored."""
        terms = self.terms[item]
        held = np.cumsum(self.df[terms])
        take = terms[:int(np.searchsorted(held, SEEDS)) + 1]
        return take, max(1, int(self.df[take].sum()) // (4 * SEEDS))


class Segment:
    """Documents of a segment: term frequencies as factors of the score, term by term."""

    def __init__(self, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, batch: Batch):
        self.batch, self.size = batch, len(sizes)
        m = 10 + (90 * sizes.astype(np.int64) * batch.documents) // max(batch.total, 1)
        doc = np.repeat(np.arange(self.size), np.diff(ends))
        tf = tfs.astype(np.int64)
        self.factors = np.zeros((len(batch.weights), self.size), np.int32)
        self.factors[terms, doc] = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])

    def scores(self, item, docs: np.ndarray) -> np.ndarray:
        terms = self.batch.terms[item]
        return self.batch.weights[terms] @ self.factors[np.ix_(terms, docs)].astype(np.int64)

    def sketches(self) -> np.ndarray:
        signs = np.random.default_rng(3).standard_normal((16, len(self.batch.weights))).astype(np.float32)
        signs *= self.batch.weights.astype(np.float32) / 1e6
        out = np.empty((16, self.size), np.float32)
        for at in range(0, self.size, 512):
            out[:, at:at + 512] = signs @ self.factors[:, at:at + 512].astype(np.float32)
        return (out / np.maximum(np.linalg.norm(out, axis=0), 1e-9)).T.copy()

    def blocks(self, docs: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a list block by block, and where each block starts."""
        if len(docs) <= BLOCK:
            return docs, np.zeros(1, np.int64)
        own = sketches[docs]
        likest = (own @ own[::BLOCK].T).argmax(axis=1)
        order = np.argsort(likest, kind="stable")
        begins = np.flatnonzero(np.diff(likest[order], prepend=-1))
        lengths = np.diff(begins, append=len(docs))
        starts = np.concatenate([np.arange(b, b + n, 2 * BLOCK) for b, n in zip(begins.tolist(), lengths.tolist(), strict=True)])
        return docs[order], starts

    def search(self, lists: dict, thresholds: dict, k: int) -> Iterator[tuple]:
        """(item, document, score) of the documents that reach their item's threshold, at most ``k`` best scores an
        item (more at a tie). ``lists``: term -> (scope, [(item, places of its terms from this one on in the scope)])."""
        sketches, found = self.sketches(), {}
        for term, (scope, askers) in lists.items():
            docs = np.flatnonzero(self.factors[term])
            if not len(docs):
                continue
            docs, starts = self.blocks(docs, sketches)
            summary = np.maximum.reduceat(self.factors[np.ix_(scope, docs)], starts, axis=1)
            lengths = np.diff(starts, append=len(docs))
            for item, places in askers:
                bounds = self.batch.weights[scope[places]] @ summary[places].astype(np.int64)
                open_ = bounds >= max(1, thresholds[item])
                if open_.any():
                    found.setdefault(item, []).append(docs[np.repeat(open_, lengths)])
        for item, parts in found.items():
            docs = np.unique(np.concatenate(parts))
            scores = self.scores(item, docs)
            least = max(1, thresholds[item], int(np.partition(scores, -k)[-k]) if len(scores) > k else 0)
            for i in np.flatnonzero(scores >= least).tolist():
                yield item, int(docs[i]), int(scores[i])


def _segments(batches: Iterator[pa.RecordBatch], batch: Batch):
    """(document ids, segment) of at most ``SEGMENT`` documents each."""
    most = int(min(SEGMENT, max(64, CELLS // max(1, len(batch.weights)))))
    held: list[pa.RecordBatch] = []

    def close(table: pa.Table):
        table = table.combine_chunks()
        terms = table["terms"].combine_chunks() if table["terms"].num_chunks != 1 else table["terms"].chunk(0)
        tfs = table["tfs"].combine_chunks() if table["tfs"].num_chunks != 1 else table["tfs"].chunk(0)
        ends = terms.offsets.to_numpy()
        flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (terms, tfs)]
        return table["doc_id"].to_pylist(), Segment(table["n"].to_numpy(), ends - ends[0], *flat, batch)

    for b in batches:
        held.append(b)
        while sum(x.num_rows for x in held) >= most:
            whole = pa.Table.from_batches(held)
            yield close(whole.slice(0, most))
            held = whole.slice(most).to_batches()
    if sum(x.num_rows for x in held):
        yield close(pa.Table.from_batches(held))


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[c.split()[0] for c in schema.split(", ")])


def _lists(batch: Batch, thresholds: dict, largest: np.ndarray) -> dict:
    """The lists that whole-list bounds leave, with the coordinates that items ask of them."""
    asked: dict[int, list] = {}
    for item, terms in batch.terms.items():
        rest = np.cumsum((batch.weights[terms] * largest[terms])[::-1])[::-1]
        for i in np.flatnonzero((rest >= max(1, thresholds[item])) & (largest[terms] > 0)).tolist():
            asked.setdefault(int(terms[i]), []).append((item, terms[i:]))
    out = {}
    for term, askers in asked.items():
        scope = np.unique(np.concatenate([t for _, t in askers]))
        out[term] = (scope, [(item, np.searchsorted(scope, t)) for item, t in askers])
    return out


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         batch_items: int = 256) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    asked = cut_lineage(asked.withColumn("batch", F.lit(0)) if (n := asked.count()) <= batch_items
                        else asked.withColumn("batch", F.pmod(F.xxhash64("item_id"), F.lit(-(-n // batch_items)))), "items")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found = None
    for number in range(max(1, -(-n // batch_items))):
        own = _rank_batch(slim, asked.where(F.col("batch") == number).select("item_id", "text").collect(), k)
        found = own if found is None else found.union(own)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _rank_batch(slim: DataFrame, rows: list, k: int) -> DataFrame:
    """item_id, doc_id, score of every document that can be among an item's best, each segment's at least."""
    items: dict = {}
    for item, text in rows:
        terms = {t for part in term_slices((text or "").encode()) for t in part}
        if terms:
            items.setdefault(item, set()).update(terms)
    numbers = {item: i for i, item in enumerate(items)}              # items travel as numbers: ids may be null
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*items.values())))}
    forward = cut_lineage(slim.mapInArrow(lambda it: _forward(it, vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>"), "forward")
    sums = forward.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    each = forward.select("n", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    m = F.lit(10) + F.expr(f"(90 * n * {sums.docs}L) div {max(1, sums.total)}L")
    factor = F.expr("(1000000000L * p.tfs) div (1000L * p.tfs + 8L * m)")
    df, largest = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    for term, n, most in each.withColumn("m", m).groupBy("p.terms").agg(F.count("*"), F.max(factor)).collect():
        df[term], largest[term] = n, most
    batch = Batch({numbers[i]: t for i, t in items.items()}, vocabulary, df, sums.docs, sums.total)
    thresholds = dict.fromkeys(batch.terms, 0)
    seeds = {item: batch.seeds(item) for item in batch.terms}

    def first(batches):
        for ids, segment in _segments(batches, batch):
            out = []
            for item, (terms, stride) in seeds.items():
                near = np.flatnonzero(segment.factors[terms].any(axis=0))[::stride]
                if len(near):
                    scores = segment.scores(item, near)
                    out += [(item, s) for s in (np.partition(scores, -k)[-k:] if len(scores) > k else scores).tolist()]
            if out:
                yield _rows(out, "item long, score long")

    tenth = Window.partitionBy("item").orderBy(F.desc("score"))
    for item, score in (forward.select("doc_id", "n", "terms", "tfs").mapInArrow(first, "item long, score long")
                        .withColumn("at", F.row_number().over(tenth)).where(F.col("at") <= k)
                        .groupBy("item").agg(F.min(F.when(F.col("at") == k, F.col("score")))).collect()):
        thresholds[item] = score or 0
    lists = _lists(batch, thresholds, largest)

    def second(batches):
        for ids, segment in _segments(batches, batch):
            if out := [(item, ids[d], score) for item, d, score in segment.search(lists, thresholds, k)]:
                yield _rows(out, "item long, doc_id long, score long")

    names = slim.sparkSession.createDataFrame([(i, item) for item, i in numbers.items()], "item long, item_id long")
    return forward.mapInArrow(second, "item long, doc_id long, score long").join(F.broadcast(names), "item").select("item_id", "doc_id", "score")
