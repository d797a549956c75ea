"""Near-duplicate classes, vector links, nearest neighbours, URL rules and the pipeline against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from interlog.llm import ann, minhash, url_filter, vector_dedup
from interlog.llm.queries import URL_RULES
from interlog.llm.shared import components

SMALL = "/root/testdata/sf0.001"


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    want = classes(range(400), links)
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(want[n] == r for n, r in got.items()) and {n for n in want if want[n] != n} <= set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash_classes_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 4, 7, 8, 9, 20, 60, 150]))]
        for _ in range(rng.randrange(1, 14)):
            own = list(base)
            for _ in range(rng.randrange(0, max(1, len(own) // 25) + 1)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(400)}"
            texts.append(" ".join(own + (["x"] if rng.random() < 0.3 else [])))
    rows = list(enumerate([*texts, None, "", " \t\n", "A b", "a B", "a"]))
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0]
    want = classes(sets, links)
    got = {r.doc_id: r for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_minhash_family_at_the_threshold(spark):
    """A large family whose members link or just fail to: their lists stay open and meet in tiles."""
    rng = random.Random(8)
    base, rows = [f"w{k}" for k in range(120)], []
    for i in range(150):
        own = list(base)
        for at in rng.sample(range(120), rng.randrange(2, 9)):
            own[at] = f"x{rng.randrange(300)}"
        rows.append((i, " ".join(own)))
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(117)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = classes(sets, links)
    assert 5 < len(links) and 20 < len(set(want.values())) < 145
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (minhash.TILE, 2000):
        got = {r.doc_id: r.component_id for r in minhash.near_copies(frame, width=4, tile=tile).collect()}
        assert got == want


def test_minhash_near_texts_go_once_to_a_task(spark, monkeypatch):
    """Near texts below the threshold share many lists; a text goes to its pivots' tasks, not to one for each list."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = []
    for i in range(40):
        text = list(base)
        for at in rng.sample(range(120), 3):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, rows[i][1] + " end") for i in (3, 9)]
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(len(t.split()) - 3)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = classes(sets, links)
    assert len(set(want.values())) > 20
    dealt, real = [], minhash.dealt

    def counted(mine, tile):
        dealt.append((mine.count(), mine.select("key").distinct().count(), mine.select("key", "doc_id").distinct().count()))
        return real(mine, tile)
    monkeypatch.setattr(minhash, "dealt", counted)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (minhash.TILE, 2000):                   # 2000: no group fits, all lists stay as they are
        got = {r.doc_id: r.component_id for r in minhash.near_copies(frame, width=4, tile=tile).collect()}
        assert got == want
    (near, tasks, once), (lists, _, _) = dealt
    assert near == once and tasks <= 42 and near * 2 < lists


def test_minhash_edges(spark, docs, no_docs):
    got = minhash.near_copies(docs).collect()
    assert len(got) == 8 and minhash.near_copies(no_docs).count() == 0
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1} and [r.component_id for r in got if r.doc_id is None] == [None]
    kept = minhash.without_copies(docs).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "5", "6", "None"]


def vectors(spark, rng):
    x = rng.standard_normal((60, 16))
    x = np.concatenate([x, x[:20] + 0.02 * rng.standard_normal((20, 16)), x[:5], 3 * x[5:8], np.zeros((1, 16))])
    rows = [(i, [float(v) for v in own], i % 3) for i, own in enumerate(x)]
    rows += [(100, None, 1), (101, [1.0, None] + [0.0] * 14, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] * 16, 1),
             (104, [float(v) for v in x[0]], None), (105, [1.0, 2.0], 1), (106, [], 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("x", F.lit("clash"))


def usable(v):
    return v and all(c is not None and np.isfinite(c) for c in v) and any(v)


def cosine(a, b):
    return float(np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)))


def test_vector_links_equal_brute_force(spark):
    rows, frame = vectors(spark, np.random.default_rng(2))
    good = [(i, v, g) for i, v, g in rows if g is not None and usable(v)]
    links = [(a, b) for a, x, g in good for b, y, h in good if a < b and g == h and len(x) == len(y) and cosine(x, y) >= 0.98]
    want = classes([i for i, _, _ in rows], links)
    for tile in (4000, 3):
        got = {r.vec_id: r for r in vector_dedup.near_vectors(frame, tile=tile).collect()}
        assert len(links) > 5 and {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {
            i: (sum(i in p for p in links), want[i], want[i] == i) for i in want}
    assert vector_dedup.near_vectors(frame.where("false")).count() == 0


def test_ann_of_a_small_table_is_exact(spark):
    rows, frame = vectors(spark, np.random.default_rng(4))
    good = [(i, v) for i, v, _ in rows if usable(v) and len(v) == 16]
    got = ann.search(frame, F.col("vec_id") % 10 == 0, block=30, chunk=4).collect()
    for q, x in good:
        if q % 10 == 0:
            best = sorted((-round(cosine(x, y), 12), i) for i, y in good if i != q)[:5]
            own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
            assert [o[0] for o in own] == [1, 2, 3, 4, 5] and [-round(o[2], 12) for o in own] == [b[0] for b in best]
    assert {r.query_id for r in got} == {i for i, _ in good if i % 10 == 0}
    assert ann.search(frame.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_ann_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 50 == 0, least=80).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(got[ids[q]] & set(ids[np.argsort(-np.where(ids == ids[q], -2, x @ x[q]))[:5]])) for q in np.flatnonzero(ids % 50 == 0)]
    assert sum(hits) >= 0.9 * 5 * len(hits)


def test_ann_recall_beside_a_group_of_near_copies(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((9000, 64))
    x[::3] = rng.standard_normal(64) + 0.1 * rng.standard_normal((3000, 64))
    frame = spark.createDataFrame([(i, own.tolist()) for i, own in enumerate(x)], "vec_id long, embedding array<double>")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 50 == 0, least=280, part=0.0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = {True: [], False: []}
    for q in range(0, 9000, 50):
        hits[q % 3 == 0].append(len(got[q] & set(np.argsort(-np.where(np.arange(9000) == q, -2, x @ x[q]))[:5])))
    assert all(sum(own) >= 0.9 * 5 * len(own) for own in hits.values())


def plain_rule(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:k]), rest[k:]
        path = rest[:next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_url_rules(spark):
    urls = ["http://A.NET/x", "https://m.example.net/en/1", "https://example.net/en", "http://x.example.com/de/?q=1&r=2", "ftp://org/fr/", "http://net",
            "http://badnet/x", None, "", "no scheme", "http://x.org/fr/a://b/c", "HTTP://U:1@h.org#frag/fr/", "http://\u00c9.net/\n/x", "x" * 50_000] * 2
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.judge_urls(frame, URL_RULES).collect()}
    for i, u in enumerate(urls):
        host, path, (rule, verdict) = plain_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and got[i].verdict in ("block", "allow")
        assert verdict is None or got[i].verdict == verdict
    assert url_filter.judge_urls(frame.where("false"), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(frame.where("url is null"), URL_RULES).collect()} == {"allow"}


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("abcd",), ("aaaa",)], "u string").select(url_filter.entropy(F.col("u"))).collect()
    assert [round(r[0], 9) for r in got] == [1.0, 0.0, 2.0, 0.0]


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline
    from interlog.session import cut_lineage

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, SMALL), "test_stage")
        assert docs.columns == columns, name
        if name == "MinHash near-dedup":
            assert docs.count() == docs.select("doc_id").distinct().count() <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.agg(F.sum("length")).first()[0] > 0 and last.where("sequence_tokens > 2048").count() == 0
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = cut_lineage(stage(spark, empty, SMALL), "test_empty")
    assert empty.count() == 0
