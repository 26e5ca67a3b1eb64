"""Stand-ins for text features, rule labels and TF-IDF with
short Latin keyword lists (the documents are Latin-script prose)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.functions.text import normalize_ws, substring_count, token_suffix_match
from sparkmart.operators.relational import with_surrogate_key
from sparkmart.plans import text_features as TF
from sparkmart.standins import Tables, register

FOOD = ["the", "tion", "ment", "and"]
NOTFOOD = ["ou", "sch", "ei"]
FINISHED = ["the", "tion", "%er", "%en", "ment"]
INGREDIENT = ["and", "ou", "ch"]

_NORM = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"
_STRIP = "regexp_replace(t, '[.,)/\\]}»”’\"'']+$', '')"


def _present(s, kws):
    return " + ".join(f"CAST(strpos({s}, '{k}') > 0 AS INTEGER)" for k in kws)


def _occ(s, kws):
    return " + ".join(f"((length({s}) - length(replace({s}, '{k}', ''))) // {len(k)})" for k in kws)


def _sfx(s, sfx):
    cond = " OR ".join(f"ends_with({_STRIP}, '{x}')" for x in sfx)
    return f"(len(list_filter(string_split({s}, ' '), lambda t: {cond})) > 0)"


@register("txt_food_feats", oracle=f"""
WITH f AS (SELECT doc_id, {_present('text', FOOD)} AS f, {_present('text', NOTFOOD)} AS n FROM documents)
SELECT doc_id, CAST(f > 0 AS INTEGER) AS is_food, f AS cnt_food, CAST(n > 0 AS INTEGER) AS is_not, n AS cnt_not,
       f - n AS food_diff, CAST(f > 0 AND n > 0 AS INTEGER) AS food_conflict FROM f
""")
def q_txt_food_feats(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text")
    return TF.food_features(docs, "text", FOOD, NOTFOOD).drop("text")


@register("txt_kw_features", oracle=f"""
WITH n AS (SELECT doc_id, {_NORM} AS s FROM documents),
h AS (SELECT doc_id, s, {_occ('s', ['the', 'tion', 'ment'])} + CAST({_sfx('s', ['er', 'en'])} AS INTEGER) AS fin,
             {_occ('s', INGREDIENT)} AS ing FROM n)
SELECT doc_id, fin AS finished_hit, ing AS ingredient_hit, CAST(fin > 0 AS INTEGER) AS any_finished,
       CAST(ing > 0 AS INTEGER) AS any_ingredient, CAST(fin > 0 AND ing > 0 AS INTEGER) AS kw_conflict,
       CAST(fin - ing AS DOUBLE) AS kw_score, CASE WHEN s = '' THEN 0 ELSE len(string_split(s, ' ')) END AS num_tokens,
       length(s) AS num_chars
FROM h
""")
def q_txt_kw_features(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text")
    return TF.keyword_features(docs, "text", FINISHED, INGREDIENT).drop("text")


@register("txt_kw_counts", oracle=f"""
SELECT doc_id, {_occ('text', ['the'])} AS n_the, {_occ('text', ['ou'])} AS n_ou, {_occ('text', ['en'])} AS n_en FROM documents
""")
def q_txt_kw_counts(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", substring_count("text", "the").alias("n_the"),
                       substring_count("text", "ou").alias("n_ou"), substring_count("text", "en").alias("n_en"))


@register("txt_suffix_match", oracle=f"""
WITH n AS (SELECT doc_id, {_NORM} AS s FROM documents)
SELECT doc_id, {_sfx('s', ['er', 'en'])} AS has_suffix, {_sfx('s', ['tion.'])} AS has_tion_dot FROM n
""")
def q_txt_suffix_match(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", token_suffix_match("text", ["er", "en"]).alias("has_suffix"),
                       token_suffix_match("text", ["tion."]).alias("has_tion_dot"))


_RULE_SQL = f"""CASE WHEN ({_present('s', ['the', 'tion', 'ment'])}) > 0 OR {_sfx('s', ['er', 'en'])} THEN '완제품'
            WHEN ({_present('s', INGREDIENT)}) > 0 THEN '식재료' END"""


@register("txt_rule_label", oracle=f"""
WITH n AS (SELECT doc_id, {_NORM} AS s FROM documents)
SELECT doc_id, {_RULE_SQL} AS rule_label FROM n
""")
def q_txt_rule_label(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", TF.rule_label(F.col("text"), FINISHED, INGREDIENT).alias("rule_label"))


@register("ml_seed_labels", oracle=f"""
WITH n AS (SELECT d.doc_id, {_NORM.replace('text', 'd.text')} AS s, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT doc_id, CASE WHEN toxic = 1 THEN '식재료' WHEN toxic = 0 THEN '완제품' END AS manual_label,
             {_RULE_SQL} AS rule_label FROM n)
SELECT doc_id, manual_label, rule_label, coalesce(manual_label, rule_label) AS seed_label,
       CASE WHEN coalesce(manual_label, rule_label) IS NULL THEN 'unlabelled' ELSE 'seed' END AS split
FROM r
""")
def q_ml_seed_labels(spark, d):
    t = Tables(spark, d)
    j = t.documents.join(t.labels, "doc_id", "left")
    manual = F.when(F.col("toxic") == 1, F.lit(TF.INGREDIENT_LABEL)).when(F.col("toxic") == 0, F.lit(TF.FINISHED_LABEL))
    out = j.select("doc_id", manual.alias("manual_label"),
                   TF.rule_label(F.col("text"), FINISHED, INGREDIENT).alias("rule_label"))
    seed = F.coalesce("manual_label", "rule_label")
    return out.select("*", seed.alias("seed_label"),
                      F.when(seed.isNull(), F.lit("unlabelled")).otherwise(F.lit("seed")).alias("split"))


@register("txt_tfidf_word", oracle="""
WITH toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN_]+') AS t FROM documents),
uni AS (SELECT doc_id, unnest(t) AS term FROM toks),
bi AS (SELECT doc_id, t[i] || ' ' || t[i + 1] AS term FROM toks, range(1, len(t)) AS r(i)),
terms AS (SELECT * FROM uni UNION ALL SELECT * FROM bi),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df.df)) + 1) AS raw
      FROM tf JOIN df ON tf.term = df.term),
n AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM w GROUP BY doc_id),
x AS (SELECT w.doc_id, w.term, w.raw / n.norm AS weight FROM w JOIN n ON w.doc_id = n.doc_id)
SELECT doc_id, count(*) AS n_terms, arg_max(term, struct_pack(wr := round(weight, 9), neg := -length(term), term := term)) AS top_term,
       round(max(weight), 6) AS top_weight, round(sum(weight * weight), 6) AS sum_sq
FROM x GROUP BY doc_id
""")
def q_txt_tfidf_word(spark, d):
    docs = Tables(spark, d).documents
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    w = TF.tfidf(TF.word_terms(docs, "doc_id", "text", (1, 2)), "doc_id", n_docs, min_df=2)
    key = F.struct(F.round("weight", 9).alias("wr"), (-F.length("term")).alias("neg"), F.col("term").alias("term"))
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.max_by("term", key).alias("top_term"),
                                   F.round(F.max("weight"), 6).alias("top_weight"),
                                   F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("sum_sq"))


@register("txt_char_df", oracle="""
WITH s AS (SELECT p_partkey, regexp_replace(lower(p_name), '\\s\\s+', ' ', 'g') AS s FROM part),
g AS (SELECT DISTINCT p_partkey, substr(s, i, n) AS term FROM s, range(3, 6) AS k(n), range(1, 64) AS r(i)
      WHERE i <= length(s) - n + 1)
SELECT term, count(*) AS df FROM g GROUP BY term
""")
def q_txt_char_df(spark, d):
    p = Tables(spark, d).part
    terms = TF.char_terms(p, "p_partkey", "p_name", (3, 5)).distinct()
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


# the character block of a product model: its n-grams, min_df and bound on the vocabulary
@register("txt_tfidf_char", oracle="""
WITH s AS (SELECT p_partkey, regexp_replace(lower(p_name), '\\s\\s+', ' ', 'g') AS s FROM part),
tf AS (SELECT p_partkey, substr(s, i, n) AS term, count(*) AS tf
       FROM (SELECT *, unnest(range(1, length(s) - n + 2)) AS i FROM s, range(2, 6) AS k(n)) GROUP BY ALL),
df AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT 120000),
w AS (SELECT p_partkey, term, tf, df, tf * (ln((1 + (SELECT count(*) FROM part)) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term))
SELECT p_partkey, term, tf, df, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY p_partkey)), 6) AS weight FROM w
""")
def q_txt_tfidf_char(spark, d):
    from sparkmart.plans.classify import HS_FOOD
    p = Tables(spark, d).part
    n = p.select(F.count(F.lit(1))).scalar()
    w = TF.tfidf(TF.char_terms(p, "p_partkey", "p_name", HS_FOOD.char_ngrams), "p_partkey", n, HS_FOOD.min_df, HS_FOOD.max_terms)
    return w.select("p_partkey", "term", "tf", "df", F.round("weight", 6).alias("weight"))


@register("ml_stratified_split", oracle="""
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || '#42')) AS rn,
                  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN rn <= floor(0.2 * n) THEN 'test' ELSE 'train' END AS part FROM r
""")
def q_ml_stratified_split(spark, d):
    from sparkmart.plans.classify import stratified_split
    return stratified_split(Tables(spark, d).labels, "doc_id", "quality", 0.2).select("doc_id", "quality", "part")
