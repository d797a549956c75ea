"""Token counts of prefixes, ranked search and spelling variants against plain recomputations."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from interlog.llm import lexical, spelling, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LOW = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lengths(library, text):
    return [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]


# ---- token counts -----------------------------------------------------------------------------------------

BITS = ["a", "e", "s", "t", "th", "'", "'s", "'re", "'ll", "1", "23", "!", "--", "<|endoftext|>", "<|startoftext|>", "<|end", " ", "\n", "\t",
        " ", "é", "é", "É", "ß", "İ", "Σ", "ς", "中", "文字", "한", "한",
        "กำ", "́", "क्षि", "\U0001f600", "ﬁ", "\x1c", "\x85", " ", "Ω", "K", "̧"]


def test_every_prefix_counts_as_the_library_does(library):
    rng = random.Random(7)
    own = token_counts.counter(PATH)
    for _ in range(1500):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 14)))
        assert [int(c) for part in own.text(text) for c in part] == lengths(library, text), text


def test_slices_and_caches_do_not_change_counts(library, monkeypatch):
    text = "Three words, they're here; three\nmore words " * 20
    whole = [int(c) for part in token_counts.PrefixCounter(PATH).text(text) for c in part]
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 7)
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 300)
    own = token_counts.PrefixCounter(PATH)
    assert [int(c) for part in own.text(text) for c in part] == whole
    assert whole[-1] == len(library.encode(text, add_special_tokens=False).ids) and len(whole) == len(text) + 1


def test_count_returns_whole_texts_and_the_longest_prefix(spark, docs, library):
    rows = token_counts.count(docs, PATH, limit=5).collect()
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    want = Counter()
    for (key, text), times in texts.items():
        short = text[:200]
        counts = lengths(library, short)
        total = len(library.encode(text, add_special_tokens=False).ids)
        fits = max(p for p, c in enumerate(counts) if c <= 5)
        want[key, len(text.encode()), total, total > 5, len(text) if total <= 5 else fits] += times
    assert Counter(map(tuple, rows)) == want


def test_the_store_answers_without_encoding(spark, docs, library):
    store = token_counts.prefix_counts(docs.where("doc_id in (2, 3, 6) or doc_id is null"), PATH, width=16).cache()
    texts = {2: "one TWO three four five six seven.", 3: "", None: "no id here at all"}
    asked = [(key, p) for key, text in texts.items() for p in range(len(text) + 2)]
    got = token_counts.tokens_at(store, spark.createDataFrame(asked, "doc_id long, chars int"), width=16).collect()
    counts = {key: lengths(library, text) for key, text in texts.items()}
    assert {(r.doc_id, r.chars): r.n_tokens for r in got} == {(k, p): counts[k][p] if p < len(counts[k]) else None for k, p in asked}
    budgets = [(key, b) for key in texts for b in range(-1, 10)] + [(99, 3)]
    got = token_counts.longest_within(store, spark.createDataFrame(budgets, "doc_id long, tokens long"), width=16).collect()
    best = lambda k, b: max((p for p, c in enumerate(counts.get(k, [])) if c <= b), default=None)
    assert {(r.doc_id, r.tokens): r.chars for r in got} == {(k, b): best(k, b) for k, b in budgets}


def test_counts_of_an_empty_table(spark, no_docs):
    assert token_counts.count(no_docs, PATH).count() == 0 and token_counts.prefix_counts(no_docs, PATH).count() == 0


# ---- ranked search ----------------------------------------------------------------------------------------

def brute_rank(docs, items, k=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    bags = [(key, Counter(split(text))) for key, text in docs]
    total, n = sum(sum(b.values()) for _, b in bags), sum(1 for _, b in bags if b)
    df = Counter(t for _, b in bags for t in b)
    terms = defaultdict(set)
    for item, text in items:
        terms[item].update(split(text))
    out = []
    for item, asked in terms.items():
        scored = []
        for key, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in asked if bag[t])
            if score > 0:
                scored.append((score, key))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r, key, score) for r, (score, key) in enumerate(scored[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("segment,seeds,batch", [(4096, 2000, 256), (32, 3, 256), (70, 1, 3)])
def test_search_returns_the_exact_ranking(spark, monkeypatch, segment, seeds, batch):
    monkeypatch.setattr(lexical, "SEGMENT", segment)
    monkeypatch.setattr(lexical, "SEEDS", seeds)
    rng = random.Random(segment)
    words = [f"w{i}" for i in range(60)] + ["Été", "UPPER", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 80]))) for _ in range(150)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[0] + " copied, w59") for i in range(60)]
    docs += [(5000, None), (5001, ""), (5002, "?! ..."), (None, texts[3]), (7, texts[7])]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(9)]
    items += [(0, "w1 upper"), (None, "w2, W3"), (50, None), (51, "..."), (52, "not there"), (53, texts[0] + " copied")]
    got = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("n", F.lit("clash")),
                       spark.createDataFrame(items, "item_id long, text string"), batch_items=batch)
    assert Counter(map(tuple, got.collect())) == brute_rank(docs, items)


def test_blocks_bound_their_documents_and_most_are_skipped(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    vocabulary = {b"%d" % i: i for i in range(200)}
    topics = [rng.choice(200, 30, replace=False) for _ in range(40)]
    docs = [np.unique(np.concatenate([rng.choice(topics[i % 40], 20), rng.integers(0, 200, 5)])) for i in range(4000)]
    df = np.bincount(np.concatenate(docs), minlength=200)
    batch = lexical.Batch({0: {b"%d" % i for i in topics[0][:12]}}, vocabulary, df, 4000, sum(map(len, docs)))
    ends = np.cumsum([0, *map(len, docs)])
    segment = lexical.Segment(np.full(4000, 40), ends, np.concatenate(docs), np.ones(ends[-1], int), batch)
    exact = segment.scores(0, np.arange(4000))
    threshold = int(np.sort(exact)[-10])
    sketches, terms, opened = segment.sketches(), batch.terms[0], 0
    for i, term in enumerate(terms):
        inside, starts = segment.blocks(np.flatnonzero(segment.factors[term]), sketches)
        assert sorted(inside) == np.flatnonzero(segment.factors[term]).tolist()
        for block in np.split(inside, starts[1:]):
            bound = int(batch.weights[terms[i:]] @ segment.factors[np.ix_(terms[i:], block)].max(axis=1))
            rest = batch.weights[terms[i:]] @ segment.factors[np.ix_(terms[i:], block)]
            assert (rest <= bound).all()
            opened += len(block) * (bound >= threshold)
    assert opened < 0.5 * sum((segment.factors[t] > 0).sum() for t in terms)
    lists = lexical._lists(batch, {0: threshold}, segment.factors.max(axis=1))
    assert {d for _, d, _ in segment.search(lists, {0: threshold}, 10)} == set(np.flatnonzero(exact >= threshold).tolist())


def test_search_of_empty_tables(spark, no_docs, docs):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.rank(no_docs, items).count() == 0 and lexical.rank(docs, items.where("false")).count() == 0


# ---- spelling variants ------------------------------------------------------------------------------------

def brute_variants(docs, least=6, every=199):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    of = {w: [v for v in n if near(w, v)] for w in n}
    form = {w: f for w in n if of[w] and n[f := min(of[w], key=lambda v: (-n[v], v))] >= 5 * n[w]}
    rows = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n[w], len(of[w]), n[form[w]] if w in form else None))
    return rows


def crowded(seed, least):
    """Texts of short-alphabet words, many of them one edit apart, some chains of forms."""
    rng = random.Random(seed)
    letters, out = "abéÉ" if seed % 2 else "abcdefghÿ", []
    for _ in range(60):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(least, least + 5)))
        times = rng.choice([5, 6, 30, 160])
        out += [word] * times
        for _ in range(4):
            i = rng.randrange(len(word) + 1)
            kind = rng.randrange(3)
            variant = word[:i] + rng.choice(letters) + word[i + (kind != 0):] if kind < 2 else word[:i] + word[i + 1:]
            out += [variant] * rng.choice([5, 6, 25])
    rng.shuffle(out)
    return [(i, " ".join(out[i::37])) for i in range(37)]


@pytest.mark.parametrize("seed,least,often", [(1, 6, 200), (2, 6, 3), (3, 6, 0), (4, 2, 20), (5, 1, 0)])
def test_variants_match_all_pairs(spark, seed, least, often):
    docs = crowded(seed, least) + [(100, None), (101, ""), (None, "aaaaaaa " * 9 + "aaaaaab " * 60), (102, "X" * 4000 + " ? " + "x" * 3999), (7, "again")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("clash"))
    got = spelling.variants(frame, min_length=least, often=often)
    assert {tuple(r) for r in got.collect()} == brute_variants(docs, least)


def test_affected_grams_bound_every_edit():
    rng = random.Random(9)
    some = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    grams = {a + b: [0, False] for a in "abc" for b in "abc"}
    for w in some[:20]:
        for i in range(len(w) - 2):
            grams.setdefault(w[i:i + 3], [0, False])
    grams = {g: (r, any(h[:2] == g and len(h) == 3 for h in grams)) for r, g in enumerate(sorted(grams))}
    for w in some:
        own = spelling.decompose(w, grams)
        left = len(own) - spelling.affected(w, own, grams)
        for i in range(len(w) + 1):
            for v in [w[:i] + c + w[i:] for c in "abc"] + [w[:i] + c + w[i + 1:] for c in "abc" if i < len(w)] + ([w[:i] + w[i + 1:]] if i < len(w) else []):
                other = Counter(spelling.decompose(v, grams))
                assert sum((Counter(own) & other).values()) >= left


def test_variants_of_an_empty_table(spark, no_docs):
    assert spelling.variants(no_docs).count() == 0
