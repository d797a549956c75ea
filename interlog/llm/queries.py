"""One registered query per operator, the corpus pipeline, and the DuckDB oracles of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from interlog.llm import (
    ann, html_text, lexical, license_scan, minhash, mixing, packing, pii, quality, spelling, token_counts, url_filter, vector_dedup)
from interlog.llm.shared import LOWER, UPPER, table

PII_KEY = "registered-query-key"
#: (verdict, host, path)
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def held_out(key: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model | float:
    return quality.train(docs, labels.where(~held_out()))


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, PII_KEY, count_col="n_entities")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, columns=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "score")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("matches")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(table(spark, sf_dir, "documents"), width=4)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.queue(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), tokenizer_path())


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pii_surrogates, op2_packing, op3_html_text, op4_embedding_dedup, op5_quality_classifier, op6_url_filter,
    op7_license_scan, op8_minhash, op9_ann, op10_mixing, op11_lexical_search, op12_token_counts, op13_spelling_variants,
    pipeline)}

_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
#: (node, root) of the nodes in ``links`` (a, b in both directions)
_ROOTS = """reach(node, other) AS (
    SELECT a, a FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
  roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_PHRASES = ", ".join(f"({_list(p.split(' '))}, '{label}')" for p, label in license_scan.PHRASES.items())
_TEMPLATES = ", ".join(f"('{label}', {_list(license_scan.words_of(t))})" for label, texts in license_scan.TEMPLATES.items() for t in texts)
_WORD = license_scan.WORD
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE: dict[str, str] = {
    "op4_embedding_dedup": f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
  u AS (SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS r FROM v),
  links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q ON p.label = q.label AND p.vec_id <> q.vec_id
    WHERE list_dot_product(p.x, q.x) / (p.r * q.r) >= 0.98),
  {_ROOTS},
  counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, vec_id = coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a LEFT JOIN roots ON vec_id = node""",
    "op7_license_scan": f"""
WITH t AS (SELECT doc_id, {_LOWER} AS t FROM documents),
  d AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS w FROM t),
  phrases(p, label) AS (VALUES {_PHRASES}),
  templates(label, words) AS (VALUES {_TEMPLATES}),
  starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE list_contains(w, 'license')),
  places AS (SELECT doc_id, i - 1 AS start, label FROM starts JOIN phrases ON w[i:i + len(p) - 1] = p),
  base AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS l
    FROM places GROUP BY doc_id),
  lines AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{_WORD}')) AS w FROM d),
  parts AS (SELECT doc_id, label, len(list_intersect(words, w)) AS k, len(words) AS n FROM lines, templates
    WHERE len(w) >= ceil(0.8 * len(words) - 1e-9)),
  method AS (SELECT doc_id, max(k / n) AS part, list(DISTINCT label) AS l FROM parts WHERE k >= ceil(0.8 * n - 1e-9) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.l), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.l, method.l))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base ON base.doc_id = d.doc_id LEFT JOIN method ON method.doc_id = d.doc_id""",
    "op8_minhash": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM d),
  x AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
  pairs AS (SELECT p.doc_id AS a, q.doc_id AS b, p.n AS m, q.n AS n, count(*) AS k FROM x p JOIN x q ON p.x = q.x AND p.doc_id <> q.doc_id
    GROUP BY ALL),
  links AS (SELECT a, b FROM pairs WHERE 100 * k >= 80 * (m + n - k)),
  {_ROOTS}
SELECT s.doc_id, len(s) AS n_shingles, coalesce(root, s.doc_id) AS component_id, s.doc_id = coalesce(root, s.doc_id) AS kept
FROM s LEFT JOIN roots ON s.doc_id = node""",
    "op10_mixing": """
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM documents),
  a AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s GROUP BY source),
  w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM a),
  f AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
    FROM w WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  fill AS (SELECT level FROM f WHERE level <= cap / weight ORDER BY cap / weight, rank LIMIT 1),
  g AS (SELECT *, least(cap::DOUBLE, coalesce((SELECT level FROM fill) * weight, cap::DOUBLE)) AS target FROM f),
  e AS (SELECT doc_id, s.source, size, source_size, target, rank, sum(size) OVER (PARTITION BY rank ORDER BY place, doc_id)::BIGINT AS done
    FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source),
  c AS (SELECT *, (source_size * copy + done) / target AS time FROM e, (VALUES (0), (1)) AS t(copy) WHERE size > 0),
  q AS (SELECT *, sum(size) OVER (ORDER BY time, rank) AS upto FROM c),
  k AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM q WHERE upto <= (SELECT sum(target) FROM g) GROUP BY doc_id)
SELECT e.doc_id, source, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM e LEFT JOIN k ON e.doc_id = k.doc_id""",
    "op11_lexical_search": f"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM documents),
  tf AS (SELECT doc_id, t, count(*) AS tf FROM words GROUP BY ALL),
  n AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
  s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
  m AS (SELECT doc_id, 100 - 90 + ((90 * n * docs) // total) AS m FROM n, s),
  asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark),
  w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t),
  scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN tf USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY ALL),
  ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_spelling_variants": f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
  found AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents),
  runs AS (SELECT run, concat(doc_id, ':', run) AS s, count(*) AS c FROM found WHERE length(run) >= 6 GROUP BY ALL),
  bytes AS (SELECT run, c, flatten(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN ord(s[i]) < 128 THEN [ord(s[i])::BIGINT]
    ELSE [(192 + (ord(s[i]) >> 6))::BIGINT, (128 + (ord(s[i]) & 63))::BIGINT] END)) AS b FROM runs),
  hashed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, b), lambda h, x: xor(h >> 8, tab[(xor(h, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
  words AS (SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word,
    sum(c)::BIGINT AS n FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(c) >= 5),
  gaps AS (SELECT word, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
  shorter AS (SELECT DISTINCT g.word, w.word AS other FROM gaps g JOIN words w ON concat(g.head, g.tail) = w.word),
  near AS (SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    UNION SELECT word, other FROM shorter UNION SELECT other, word FROM shorter),
  best AS (SELECT near.word, other, o.n AS other_n, w.n, count(*) OVER (PARTITION BY near.word) AS n_near,
      row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
    FROM near JOIN words w ON near.word = w.word JOIN words o ON other = o.word),
  forms AS (SELECT word, other AS form, other_n AS form_n FROM best WHERE place = 1 AND other_n >= 5 * n),
  path(word, root) AS (SELECT word, word FROM words UNION ALL SELECT path.word, form FROM path JOIN forms ON root = forms.word),
  roots AS (SELECT path.word, root FROM path WHERE root NOT IN (SELECT word FROM forms))
SELECT words.word, form, root, words.n, coalesce(n_near, 0) AS n_near, form_n
FROM words JOIN roots ON words.word = roots.word LEFT JOIN forms ON words.word = forms.word
  LEFT JOIN best ON words.word = best.word AND place = 1""",
}
