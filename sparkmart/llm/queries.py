"""The registered queries of the operators: each reads its whole table, runs
its operator with production parameters and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import (
    bpe, collocations, decontaminate, jaccard_join, language_id, lexical_search, mtree_search, ngram_lm, quote_linking,
    simhash_dedup, substring_dedup, token_counts, toxicity,
)
from sparkmart.llm.common import held_out, prepare


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = Query(name, fn, oracle)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def learn():
    """The rows that classifiers may learn from."""
    return ~held_out("doc_id")


@register("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, eligible=learn())
    got = language_id.predict(docs, model)
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@register("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), eligible=learn())
    got = toxicity.score(docs, model)
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted",
                      F.size("offending").alias("n_offending"))


@register("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


DECONTAMINATE_SQL = r"""
WITH item AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL),
item2 AS (SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k FROM item WHERE len(w) > 0),
doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL),
ipos AS (SELECT item_id, n, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
         FROM (SELECT *, unnest(range(1, n - k + 2)) AS p FROM item2)),
ks AS (SELECT DISTINCT k FROM item2),
dpos AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
         FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM doc, ks WHERE len(w) >= k)),
dlen AS (SELECT doc_id, len(w) AS len FROM doc),
hit AS (SELECT DISTINCT d.doc_id, i.item_id, i.n, i.k, d.p - i.p AS st FROM dpos d JOIN ipos i USING (k, g)),
win AS (SELECT DISTINCT doc_id, item_id, n, k, s
        FROM (SELECT h.*, unnest(range(st - n // 5, st + n // 5 + 1)) AS s FROM hit h) JOIN dlen USING (doc_id)
        WHERE s >= 0 AND s + n <= len),
wg AS (SELECT doc_id, item_id, n, k, s, g, count(*) AS c
       FROM win JOIN dpos USING (doc_id, k) WHERE p > s AND p <= s + n - k + 1 GROUP BY ALL),
ig AS (SELECT item_id, k, g, count(*) AS c FROM ipos GROUP BY ALL),
shared AS (SELECT doc_id, item_id, n, k, s, sum(least(wg.c, ig.c)) AS i FROM wg JOIN ig USING (item_id, k, g) GROUP BY ALL),
sim AS (SELECT doc_id, item_id, n, s, i / (2 * (n - k + 1) - i) AS similarity FROM shared)
SELECT doc_id, item_id, CAST(similarity AS DOUBLE) AS similarity, CAST(s AS INTEGER) AS start, CAST(n AS INTEGER) AS n_words
FROM sim WHERE similarity >= 0.8 - 1e-12
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) = 1
"""


@register("op3_decontaminate", DECONTAMINATE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start", "n_words")


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
dup AS (SELECT doc_id, p FROM win QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS p FROM dup),
word AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT word.doc_id, string_agg(w[word.p], ' ' ORDER BY word.p) AS text, count(*) AS n
         FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p
         WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@register("op1_substring_dedup", SUBSTRING_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), keep_text=False)


JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
meet AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM g x JOIN g y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b, i = sa.n AND i = sb.n AS same FROM meet JOIN size sa ON sa.doc_id = a JOIN size sb ON sb.doc_id = b
         WHERE i >= 0.8 * (sa.n + sb.n - i) - 1e-9
         UNION ALL SELECT x.doc_id, y.doc_id, true FROM d x, d y WHERE len(x.w) = 0 AND len(y.w) = 0 AND x.doc_id <> y.doc_id),
reach AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN link l ON l.a = r.a)
SELECT doc_id, CAST(class_id AS BIGINT) AS class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       CAST(1 + coalesce(s, 0) AS BIGINT) AS n_copies
FROM (SELECT a AS doc_id, min(c) AS class_id FROM reach GROUP BY a)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n, count(*) FILTER (same) AS s FROM link GROUP BY a) USING (doc_id)
"""


@register("op2_jaccard_join", JACCARD_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@register("op9_topk_search", TOP_K_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUOTES_SQL = r"""
WITH RECURSIVE line AS (
  SELECT rid, conv_id, turn, role, i, coalesce(length(regexp_replace(regexp_extract(l, '^(?:[ \t]*>)+'), '[^>]', '', 'g')), 0) AS level,
         CASE WHEN regexp_extract(l, '^(?:[ \t]*>)+') = '' THEN l ELSE trim(l[length(regexp_extract(l, '^(?:[ \t]*>)+')) + 1:]) END AS body
  FROM (SELECT rid, conv_id, turn, role, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM (
          SELECT row_number() OVER () AS rid, conv_id, turn, role, regexp_split_to_array(text, '\r?\n') AS ls FROM conversations))),
kept AS (SELECT * FROM (SELECT *, lead(level, 1, 0) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM line)
         WHERE NOT (level = 0 AND nxt > 0 AND regexp_full_match(lower(body), '\s*on .* wrote:\s*'))),
run AS (SELECT *, sum(CASE WHEN level = prev THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS no
        FROM (SELECT *, lag(level, 1, -1) OVER (PARTITION BY rid ORDER BY i) AS prev FROM kept)),
norm AS (SELECT *, regexp_replace(trim(regexp_replace(lower(body), '\s+', ' ', 'g')), '^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$', '', 'g') AS h FROM run),
own AS (SELECT rid, any_value(conv_id) AS conv_id, any_value(turn) AS turn,
               trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0), ''), chr(10) || ' ') AS text,
               count(DISTINCT no) FILTER (level > 0) AS n_quotes FROM run GROUP BY rid),
unit AS (SELECT conv_id, turn, h FROM norm WHERE level = 0 AND h <> '' UNION
         SELECT conv_id, turn, regexp_replace(trim(regexp_replace(lower(p), '\s+', ' ', 'g')), '^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$', '', 'g')
         FROM (SELECT conv_id, turn, unnest(list_append(regexp_split_to_array(text, '\n\s*\n'), text)) AS p FROM own)),
origin AS (SELECT conv_id, h, min(turn) AS origin FROM unit WHERE h <> '' GROUP BY ALL),
whole AS (SELECT rid, conv_id, turn, no, level, 0 AS place, regexp_replace(trim(regexp_replace(lower(string_agg(body, ' ' ORDER BY i)),
            '\s+', ' ', 'g')), '^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$', '', 'g') AS h FROM run WHERE level > 0 GROUP BY ALL),
quote AS (SELECT * FROM whole UNION ALL SELECT rid, conv_id, turn, no, level, 1 + i AS place, h FROM norm WHERE level > 0),
met AS (SELECT rid, no, level, arg_min(origin, place) AS origin FROM quote JOIN origin USING (conv_id, h) WHERE origin < turn GROUP BY ALL),
reply AS (SELECT rid, arg_min(origin, level * 1000000 + no) AS reply_to, count(*) AS n_linked FROM met GROUP BY rid),
up AS (SELECT conv_id, turn, min(reply_to) AS top FROM reply JOIN own USING (rid) GROUP BY ALL),
chain AS (SELECT conv_id, turn, top FROM up UNION ALL
          SELECT c.conv_id, c.turn, u.top FROM chain c JOIN up u ON u.conv_id = c.conv_id AND u.turn = c.top),
roots AS (SELECT conv_id, turn, min(top) AS top FROM chain GROUP BY ALL)
SELECT *, CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN row_number() OVER (PARTITION BY conv_id ORDER BY
         thread NULLS LAST, turn NULLS FIRST, role NULLS FIRST, text, reply_to NULLS FIRST, n_quotes, n_linked) END AS position,
       '<|' || coalesce(role, 'user') || '|>' || chr(10) || text || chr(10) || '<|end|>' AS chat
FROM (
SELECT c.conv_id, c.turn, c.role, reply_to, coalesce(top, c.turn) AS thread, CAST(coalesce(n_quotes, 0) AS INTEGER) AS n_quotes,
       CAST(coalesce(n_linked, 0) AS INTEGER) AS n_linked, coalesce(own.text, '') AS text
FROM (SELECT row_number() OVER () AS rid, * FROM conversations) c LEFT JOIN own USING (rid) LEFT JOIN reply USING (rid)
LEFT JOIN roots ON roots.conv_id = c.conv_id AND roots.turn = c.turn)
"""


@register("op4_quote_linking", QUOTES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_linking.render(quote_linking.in_order(quote_linking.link(table(spark, sf_dir, "conversations"))))


@register("op10_ngram_lm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 7, 2)
    got = ngram_lm.score(docs, ngram_lm.build(docs.where(~out)))
    return got.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


LEXICAL_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT count(*) FILTER (len(t) > 0) AS n_all, sum(len(t)) AS l_all FROM d),
asked AS (SELECT row_number() OVER () AS qid, item_id,
                 regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
          FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT qid, item_id, term, count(*) AS c FROM (SELECT qid, item_id, unnest(t) AS term FROM asked) GROUP BY ALL),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, n_all),
hit AS (SELECT qid, item_id, rid, doc_id,
               CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_all) // l_all)))) AS BIGINT) AS score
        FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM hit WHERE score > 0 QUALIFY rank <= 20
"""


@register("op13_lexical_search", LEXICAL_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_simhash_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.dedup(table(spark, sf_dir, "documents"))


COLLOCATIONS_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents WHERE text IS NOT NULL),
f1 AS (SELECT lang, w AS p, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM piece) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
f2 AS (SELECT lang, x, y, count(*) AS f FROM (SELECT lang, w[i] AS x, w[i + 1] AS y FROM
         (SELECT lang, w, unnest(range(1, len(w))) AS i FROM piece WHERE len(w) > 1)) GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM
         (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM piece WHERE len(w) > 2)) GROUP BY ALL HAVING count(*) >= 10),
long AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
cut AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.p = f2.x JOIN f1 r ON r.lang = f2.lang AND r.p = f2.y
  LEFT JOIN long ON long.lang = f2.lang AND long.x = f2.x AND long.y = f2.y
  WHERE long.f IS NULL OR 100 * long.f < 50 * f2.f
  UNION ALL SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, 1, l.f, r.f
  FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.p = f3.x JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
  UNION ALL SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, 2, l.f, r.f
  FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y JOIN f1 r ON r.lang = f3.lang AND r.p = f3.z),
scored AS (SELECT *, CAST((CAST(a AS HUGEINT) * a * 1000000) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cut),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r, n, score
FROM weakest JOIN total USING (lang) QUALIFY rank <= 2000
"""


@register("op11_collocations", COLLOCATIONS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))
