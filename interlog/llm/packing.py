"""Packing: documents become token windows of near-equal fill by multiway differencing.

Every document is tokenised whole and closed with an end id. Full windows are cut off first; the
tails are cut into pieces and dealt to windows by Karmarkar-Karp differencing: the two partial
partitions with the largest imbalance are merged, the fullest window of one with the emptiest of the
other, until one partition is left. If its fullest window exceeds the capacity, the window count rises
by one and the differencing starts again.

The work streams through each task: a differencing group holds the tails of a fixed number of windows,
so memory does not grow with the table, there is no shuffle and a lost task is simply run again.

Defined results: null text counts as empty (one end id); repeated rows are packed as often as they come;
an empty table gives no piece; only the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long")
END_ID = 1                       # closes every document
CACHE_WORDS = 400_000            # words of a cache generation; a worker keeps two
FIRST_ODD = "\u0130"             # below it, lower case and composition are one character each
ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Item indexes of each window after differencing ``sizes`` into ``windows`` parts."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[-1] = size
        heap.append((-size, i, sums, [None] * (windows - 1) + [i]))
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]                      # both ascending: fullest meets emptiest
        order = np.argsort(sums, kind="stable")
        in_b.reverse()
        sums = sums[order]
        sums -= sums[0]
        held = []
        for k in order.tolist():
            x, y = in_a[k], in_b[k]
            held.append(y if x is None else x if y is None else (x, y))
        heapq.heappush(heap, (-int(sums[-1]), tie, sums, held))
        tie += 1
    return [_items(node) for node in heap[0][3]] if heap else [[] for _ in range(windows)]


def _items(node) -> list[int]:
    found, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            stack.extend((x[1], x[0]))
        elif x is not None:
            found.append(x)
    return found


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until the fullest fits."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = difference(sizes, windows)
        if max((sum(sizes[i] for i in w) for w in dealt), default=0) <= capacity:
            return [w for w in dealt if w]
        windows += 1


class _Learned(dict):
    """Words and their ranks; a missing word is learned when it is asked for."""

    def __init__(self, learn):
        super().__init__({"": b""})
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.learn(word)
        return found


class WordTokenizer:
    """Ids of whole texts, word by word through a cache of bounded size.

    The vocabulary's words never cross white space, so a text's ids are those of its words in order. Plain words
    are merged by a byte-pair encoder over the same merges, in which a byte of its own stands for the end of a
    word; every merged token of the vocabulary is what its own bytes encode to, so both make the same merges.
    Other words go through the vocabulary's own pipeline.
    """

    WORD_END = b"\xff"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        # the vocabulary's spelling: visible bytes as themselves, the others from U+0100 on
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of = {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)}.difference(seen)))}
        byte_of = {c: b for b, c in of.items()}
        end = model["end_of_word_suffix"]
        as_bytes = lambda token: (bytes(byte_of[c] for c in token.removesuffix(end))
                                  + (self.WORD_END if token.endswith(end) else b""))
        ranks, ids = {bytes([b]): b for b in range(256)}, [model["vocab"][of[b]] for b in range(256)]
        tokens = [of[b] + end for b in sorted(of)]
        tokens += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        for token in tokens:
            if (own := as_bytes(token)) not in ranks:
                ranks[own] = len(ids)
                ids.append(model["vocab"][token])
        self.lookup = np.array(ids, "<u4")
        self.rank_of = {v: k for k, v in enumerate(ids)}
        self.tokens = list(ranks)                        # by rank
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.words: dict[str, bytes] = _Learned(self._learn)
        self.older: dict[str, bytes] = {}                # the generation before, still looked up

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            if len(self.words) > CACHE_WORDS:
                self.older, self.words = self.words, _Learned(self._learn)
            words = text.replace("\n", " ").split(" ")
            ranks = np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.uint32)
            ids = np.full(len(ranks) + 1, END_ID, "<u4")
            ids[:-1] = self.lookup[ranks]
            out.append(ids)
        return out

    def _learn(self, w: str) -> bytes:
        known = self.older.get(w)
        if known is not None:
            return known
        if w.isalpha() and (w.isascii() or max(w) < FIRST_ODD):
            return array("I", self.merge(w.lower().encode() + self.WORD_END)).tobytes()
        return b"".join([self._part(p) for p in self._pieces(w)])

    def _part(self, part: str) -> bytes:
        known = self.words.get(part)
        if known is None:
            if part.isascii() or part.isalpha() and max(part) < FIRST_ODD:
                known = array("I", self.merge(part.lower().encode() + self.WORD_END)).tobytes()
            else:
                ids = self.model.encode(part, add_special_tokens=False).ids
                known = array("I", [self.rank_of[i] for i in ids]).tobytes()
        return known

    @staticmethod
    def _pieces(word: str) -> list[str]:
        """Parts that the vocabulary's own splitting keeps apart in any case."""
        if word.isascii():
            return ASCII_PARTS.findall(word.lower())
        core = word.rstrip("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
        return [core, word[len(core):]] if core and len(core) < len(word) and core[-1].isalpha() else [word]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer, whose words serve all tasks that the worker runs."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, group: int, piece: int,
          slack: int) -> Iterator[pa.RecordBatch]:
    ids_of = tokenizer(path).ids
    next_id = TaskContext.get().partitionId() << 36
    room = group * (capacity - slack)           # tokens of one differencing group
    tails: list[tuple] = []                     # (doc_id, start, length, crc, doc_tokens)
    held = 0
    rows: list[tuple] = []

    def close() -> None:
        nonlocal next_id, held
        for window in deal([t[2] for t in tails], capacity):
            offset, tokens = 0, sum(tails[i][2] for i in window)
            for i in window:
                rows.append((*tails[i], next_id, offset, tokens))
                offset += tails[i][2]
            next_id += 1
        tails.clear()
        held = 0

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            keys, texts = (c.to_pylist() for c in batch.slice(at, 64).columns)
            for key, ids in zip(keys, ids_of(texts), strict=True):
                total, start = len(ids), 0
                while total - start >= capacity:
                    own = ids[start:start + capacity]
                    rows.append((key, start, capacity, zlib.crc32(own.tobytes()), total, next_id, 0, capacity))
                    next_id += 1
                    start += capacity
                while start < total:
                    take = min(piece, total - start, room - held)
                    own = ids[start:start + take]
                    tails.append((key, start, take, zlib.crc32(own.tobytes()), total))
                    start += take
                    held += take
                    if held == room:
                        close()
            if len(rows) > 20_000:
                yield _batch(rows)
                rows = []
    if tails:
        close()
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         group: int = 64, piece: int = 512, slack: int = 4) -> DataFrame:
    """One row per piece: where it starts in its document and where it lies in its sequence.

    ``group`` windows are differenced together, tails are cut into pieces of at most ``piece`` tokens, and
    a full group leaves ``slack`` tokens a window for the imbalance that differencing leaves.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.mapInArrow(lambda it: _pack(it, tokenizer_path, capacity, group, piece, slack), SCHEMA)
