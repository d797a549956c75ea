"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line is described by its own features and those of the lines before and after it; the chain's transitions
carry what surrounds it. Forward-backward marginals, weighted by line length, give a document's share of good
text, which a logistic curve fitted on the training documents turns into the score.

Only documents have labels, so in training a document's lines carry its label. The chain is fitted on a sample
of at most about ``max_train`` labelled documents (a hash threshold, so every run takes the same ones); it is
small and is fitted on the driver. Scoring streams over whole texts in bounded byte ranges.

Defined results: a null or empty text is one empty line; documents with equal texts score alike; without
labels of both kinds every score is the share of label 1 (0.5 without any); an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from interlog.llm.shared import SPACES, Hashes, slices, unused, utf8, words

LETTER, UPPER, DIGIT, SPACE, STOP, MARK, WIDE, CONTROL = range(8)
KINDS = np.full(256, CONTROL, np.uint8)
KINDS[97:123], KINDS[65:91], KINDS[48:58], KINDS[128:] = LETTER, UPPER, DIGIT, WIDE
KINDS[SPACES] = SPACE
KINDS[list(b".,;:?'\"()-")] = STOP
KINDS[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = MARK
# Frequent words of the corpus languages.
COMMON = "the of and to in is that for it was with are this de la que el en y los las del le les et des un une est der die das und zu den von mit im".split()
RANGE = 1 << 20                 # bytes of text worked on at once
HASHES = Hashes()


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, its length in bytes, lines per document)."""
    breaks = np.flatnonzero(data == 10)
    keys = np.sort(np.concatenate([2 * breaks + 1, 2 * offsets[1:]]))
    ends, broken = keys >> 1, (keys & 1).astype(bool)
    starts = np.concatenate([[0], ends[:-1] + broken[:-1]])
    doc = np.concatenate([[0], np.cumsum(~broken)[:-1]])
    n, length = len(ends), ends - starts
    line = np.searchsorted(starts, np.arange(len(data)), "right") - 1 if len(data) < 4096 else _line_of(starts, len(data))
    counts = np.bincount(line * 8 + KINDS[data], minlength=8 * n).reshape(n, 8)
    counts[:, SPACE] -= np.bincount(line[breaks], minlength=n)
    size = np.maximum(length, 1)[:, None]
    shares = counts / size

    prefix = HASHES.prefix(data)
    begin, end = words(data, offsets)
    of = line[begin] if len(begin) else np.zeros(0, np.int64)
    hashes = HASHES.ranges(prefix, begin, end)
    n_words = np.bincount(of, minlength=n)
    again = np.zeros(len(of), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((hashes, of))
    new = np.ones(len(of), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
    per = lambda mask, where: np.bincount(where, mask, minlength=n) / np.maximum(n_words, 1)
    marked = KINDS[data[end - 1]] == MARK if len(end) else np.zeros(0, bool)
    whole = HASHES.ranges(prefix, starts, ends)
    by_line = np.lexsort((whole, doc))
    same = (whole[by_line][1:] == whole[by_line][:-1]) & (doc[by_line][1:] == doc[by_line][:-1])
    twin = np.zeros(n, bool)
    twin[by_line[1:]] |= same
    twin[by_line[:-1]] |= same
    last = np.where(length > 0, data[np.maximum(ends - 1, 0)] if len(data) else 0, 0)
    first = np.where(length > 0, data[np.minimum(starts, max(len(data) - 1, 0))] if len(data) else 0, 0)
    repeats, distinct, common = per(again, of), per(new, of[order]), per(np.isin(hashes, COMMON_HASHES), of)
    marks = per(marked, of)
    up = counts[:, UPPER] / np.maximum(counts[:, UPPER] + counts[:, LETTER], 1)
    x = np.column_stack([
        shares, np.log1p(length), np.log1p(n_words), (length / np.maximum(n_words, 1)).clip(0, 40) / 10, repeats, distinct,
        common, marks, marks > 0.5, up, up > 0.6, repeats > 0.3, twin & (length > 0), last == 46, KINDS[first] == UPPER,
        n_words <= 1, length == 0])
    return x.astype(np.float64), length, np.bincount(doc, minlength=len(offsets) - 1)


def _line_of(starts: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    return np.cumsum(step[:n]) - 1


def _common_hashes() -> np.ndarray:
    out = []
    for w in COMMON:
        data = np.frombuffer(w.encode(), np.uint8)
        out.append(HASHES.ranges(HASHES.prefix(data), np.array([0]), np.array([len(data)]))[0])
    return np.array(out, np.uint64)


COMMON_HASHES = _common_hashes()


def with_neighbours(x: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """A line's features, those of the lines before and after it, and whether these exist."""
    starts = np.cumsum(per_doc) - per_doc
    first, last = np.zeros(len(x), bool), np.zeros(len(x), bool)
    first[starts[per_doc > 0]] = True
    last[(starts + per_doc - 1)[per_doc > 0]] = True
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first], after[last] = 0, 0
    return np.column_stack([x, before, after, first, last, np.ones(len(x))])


def padded(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps, documents) with zeros after a document's end, and which cells hold a line."""
    steps = np.arange(lengths.max())[:, None]
    held = steps < lengths
    return np.where(held, values[np.where(held, starts + steps, 0)], 0.0), held


def _step(r: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.logaddexp(r + t[1, 1], t[0, 1]) - np.logaddexp(r + t[1, 0], t[0, 0])


def forward_backward(e: np.ndarray, held: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good given what came up to a line (it included), and given what follows it.

    ``e`` (steps, documents) holds each line's log odds by its features, ``t[a, b]`` the transition scores.
    """
    up, down = np.empty_like(e), np.zeros_like(e)
    up[0] = e[0]
    for k in range(1, len(e)):
        up[k] = e[k] + _step(up[k - 1], t)
    for k in range(len(e) - 2, -1, -1):
        down[k] = np.where(held[k + 1], _step(down[k + 1] + e[k + 1], t.T), 0.0)
    return up, down


class Model:
    """Feature scaling, line weights, transitions and the curve from the share of good text to a score."""

    def __init__(self, mean, spread, weights, moves, curve):
        self.mean, self.spread, self.weights, self.moves, self.curve = mean, spread, weights, moves, curve

    def marginals(self, x: np.ndarray, per_doc: np.ndarray, cells: int = 1 << 21) -> np.ndarray:
        """Chance of good for every line."""
        e = with_neighbours((x - self.mean) / self.spread, per_doc) @ self.weights
        starts, out = np.cumsum(per_doc) - per_doc, np.zeros(len(x))
        order = np.argsort(per_doc, kind="stable")
        order = order[per_doc[order] > 0]
        at = len(order)
        while at:                                           # documents of like length together, longest first
            to = max(0, at - max(1, cells // int(per_doc[order[at - 1]])))
            while to < at - 1 and per_doc[order[to]] * 2 < per_doc[order[at - 1]]:
                to += max(1, (at - to) // 2)
            own = order[to:at]
            steps, held = padded(e, starts[own], per_doc[own])
            up, down = forward_backward(steps, held, self.moves)
            where = (starts[own] + np.arange(len(steps))[:, None])[held]
            out[where] = (1 / (1 + np.exp(-np.clip(up + down, -40, 40))))[held]
            at = to
        return out

    def scores(self, x: np.ndarray, length: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        share = good_share(self.marginals(x, per_doc), length, per_doc)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * share + self.curve[1], -40, 40)))


def good_share(chance: np.ndarray, length: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Log odds of the length-weighted mean marginal."""
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    weight = length + 1e-3
    share = np.bincount(doc, weight * chance, len(per_doc)) / np.maximum(np.bincount(doc, weight, len(per_doc)), 1e-9)
    share = share.clip(1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def fit(x: np.ndarray, length: np.ndarray, per_doc: np.ndarray, good: np.ndarray, rounds: int = 200, segment: int = 64,
        l2: float = 5e-3) -> Model:
    """Maximum likelihood of the chains by Adam; chains longer than ``segment`` lines are cut for training."""
    mean, spread = x.mean(0), x.std(0) + 1e-3
    phi = with_neighbours((x - mean) / spread, per_doc)
    pieces, labels = [], []
    for s, n, y in zip(np.cumsum(per_doc) - per_doc, per_doc, good, strict=True):
        for k in range(0, n, segment):
            pieces.append((s + k, min(segment, n - k)))
            labels.append(y)
    starts, lengths = np.array(pieces).T
    y = np.array(labels, float)
    weight = 1 / np.sqrt(lengths) / np.sum(1 / np.sqrt(lengths))
    w, t = np.zeros(phi.shape[1]), np.zeros((2, 2))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, t)]
    steps = np.arange(lengths.max())[:, None]
    held = steps < lengths
    rows = np.where(held, starts + steps, 0)
    pairs = held[1:]
    for k in range(1, rounds + 1):
        e = np.where(held, (phi @ w)[rows], 0.0)
        up, down = forward_backward(e, held, t)
        chance = 1 / (1 + np.exp(-np.clip(up + down, -40, 40)))
        wrong = np.where(held, (y - chance) * weight, 0.0)
        of_w = phi.T @ np.bincount(rows[held], wrong[held], len(phi)) - l2 * w
        of_t = np.zeros((2, 2))
        if len(pairs):
            after = e[1:] + down[1:]
            logs = np.array([[np.zeros_like(after) + t[0, 0], after + t[0, 1]], [up[:-1] + t[1, 0], up[:-1] + after + t[1, 1]]])
            joint = np.exp(logs - np.logaddexp.reduce(logs.reshape(4, *after.shape), 0))
            for a in (0, 1):
                for b in (0, 1):
                    seen = (y == a) & (a == b)
                    of_t[a, b] = np.sum(np.where(pairs, (seen - joint[a, b]) * weight, 0.0))
            of_t -= 1e-3 * t
        for p, g, (m, v) in zip((w, t), (of_w, of_t), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    model = Model(mean, spread, w, t, (1.0, 0.0))
    z = good_share(model.marginals(x, per_doc), length, per_doc)
    a, b = 1.0, 0.0
    for _ in range(50):                                     # Newton steps, drawn a little to the plain share
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = np.array([np.mean((good - p) * z) - 0.01 * (a - 1), np.mean(good - p) - 0.01 * b])
        v = p * (1 - p)
        h = np.array([[np.mean(v * z * z), np.mean(v * z)], [np.mean(v * z), np.mean(v)]]) + 0.01 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    model.curve = (max(a, 1e-3), b)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_train: int = 4000) -> Model | float:
    """A model from labelled documents, or the constant score where the labels are not of both kinds."""
    key = unused([*docs.columns, *labels.columns], "_id")
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias(key)).agg(F.min(label_col).cast("double").alias("good")))
    n = known.count()
    part = F.pmod(F.xxhash64(key), F.lit(1_000_000)) < (max_train / max(n, 1)) * 1_000_000
    # the labels of the sample are at most about max_train rows, so they go to every task
    slim = docs.select(F.col(id_col).alias(key), F.col(text_col).alias("text"))
    sample = slim.join(F.broadcast(known.where(part)), key).select("good", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.asarray(batch.column(0))
            data, offsets = utf8(batch.column(1))
            for at, to in slices(offsets, RANGE):
                x, length, per_doc = line_features(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
                ends = np.cumsum(per_doc)
                yield pa.RecordBatch.from_arrays([
                    pa.array(good[at:to]), pa.array([x[e - k:e].astype("<f4").tobytes() for e, k in zip(ends, per_doc, strict=True)]),
                    pa.array([length[e - k:e].astype("<i8").tobytes() for e, k in zip(ends, per_doc, strict=True)])], names=["good", "x", "length"])

    rows = sample.mapInArrow(describe, "good double, x binary, length binary").toPandas().sort_values(["good", "x"])
    good = rows["good"].to_numpy(float)
    if len(good) == 0 or good.min() == good.max():
        return float(good.mean()) if len(good) else 0.5
    length = [np.frombuffer(v, "<i8") for v in rows["length"]]
    per_doc = np.array([len(v) for v in length])
    x = np.frombuffer(b"".join(rows["x"]), "<f4").reshape(per_doc.sum(), -1).astype(float)
    return fit(x, np.concatenate(length), per_doc, good)


def score(docs: DataFrame, model: Model | float, text_col: str = "text", name: str = "score",
          columns: list[str] | None = None) -> DataFrame:
    """The named columns of ``docs`` (all by default) and a score column; whole texts are read."""
    columns = docs.columns if columns is None else columns
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = StructType([StructField(c, kinds[c]) for c in columns]).add(name, DoubleType())
    read = [docs[c] for c in columns] + ([] if text_col in columns else [docs[text_col]])
    at_text = columns.index(text_col) if text_col in columns else len(columns)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at_text))
            out = np.full(len(offsets) - 1, model if isinstance(model, float) else 0.0)
            for at, to in slices(offsets, RANGE) if not isinstance(model, float) else ():
                out[at:to] = model.scores(*line_features(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.array(out)], names=[*columns, name])

    return docs.select(*read).mapInArrow(scored, schema)
