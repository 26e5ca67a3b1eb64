"""Text features for the product classifiers, as Spark expressions.

All features are built-in column expressions over a keyword *array literal*
(bounded, shipped with the plan), so they run inside whole-stage codegen with
no Python; TF-IDF is computed with explode / aggregate / join so the
vocabulary statistics are distributed too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.text import normalize_ws, token_suffix_match
from sparkmart.plans.keywords import FINISHED_KEYWORDS, INGREDIENT_KEYWORDS, split_keywords

FINISHED_LABEL = "완제품"
INGREDIENT_LABEL = "식재료"
# Unicode word-character runs (Python's (?u)\w+)
WORD_RE = r"[\p{L}\p{N}_]+"


def _arr(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def _once(text: Column, fn) -> Column:
    """``fn`` of the text bound to a variable: inside a keyword loop the text's
    own expression would otherwise be computed for every keyword."""
    return F.element_at(F.transform(F.array(text), fn), 1)


def n_present(text: Column, keywords: Sequence[str]) -> Column:
    """How many distinct keywords occur in the text (``sum(kw in t)``)."""
    return _once(text, lambda t: F.size(F.filter(_arr(keywords), lambda k: F.instr(t, k) > 0)))


def n_occurrences(text: Column, keywords: Sequence[str]) -> Column:
    """Total non-overlapping occurrences of all keywords (``sum(t.count(kw))``)."""
    if not keywords:
        return F.lit(0)
    return _once(text, lambda t: F.aggregate(
        _arr(keywords), F.lit(0), lambda acc, k: acc + ((F.length(t) - F.length(F.replace(t, k, F.lit("")))) / F.length(k)).cast("int")))


def food_features(df: DataFrame, text: str, food: Sequence[str], notfood: Sequence[str]) -> DataFrame:
    """is_food, cnt_food, is_not, cnt_not, diff, conflict."""
    t = F.col(text)
    f, n = n_present(t, food), n_present(t, notfood)
    return df.select("*", (f > 0).cast("int").alias("is_food"), f.alias("cnt_food"),
                     (n > 0).cast("int").alias("is_not"), n.alias("cnt_not"), (f - n).alias("food_diff"),
                     ((f > 0) & (n > 0)).cast("int").alias("food_conflict"))


def keyword_features(df: DataFrame, text: str, finished: Sequence[str] = FINISHED_KEYWORDS,
                     ingredient: Sequence[str] = INGREDIENT_KEYWORDS) -> DataFrame:
    """Eight finished / ingredient features on the normalised text."""
    base, sfx = split_keywords(list(finished))
    s = normalize_ws(F.col(text))
    fin = n_occurrences(s, base) + token_suffix_match(s, sfx).cast("int")
    ing = n_occurrences(s, list(ingredient))
    return df.select(
        "*", fin.alias("finished_hit"), ing.alias("ingredient_hit"),
        (fin > 0).cast("int").alias("any_finished"), (ing > 0).cast("int").alias("any_ingredient"),
        ((fin > 0) & (ing > 0)).cast("int").alias("kw_conflict"), (fin - ing).cast("double").alias("kw_score"),
        F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, " "))).alias("num_tokens"),
        F.length(s).alias("num_chars"))


def rule_label(text: Column, finished: Sequence[str] = FINISHED_KEYWORDS,
               ingredient: Sequence[str] = INGREDIENT_KEYWORDS) -> Column:
    """Finished keyword / suffix first, then ingredient keyword, else NULL."""
    base, sfx = split_keywords(list(finished))
    s = normalize_ws(text)
    fin = (n_present(s, base) > 0) | token_suffix_match(s, sfx)
    ing = n_present(s, list(ingredient)) > 0
    return F.when(fin, F.lit(FINISHED_LABEL)).when(ing, F.lit(INGREDIENT_LABEL)).otherwise(F.lit(None).cast("string"))


def label_int(label: Column) -> Column:
    return F.when(label == INGREDIENT_LABEL, F.lit(1)).when(label == FINISHED_LABEL, F.lit(0))


CHARS_A_TASK = 1 << 20      # of text: a task counts the terms of at most so much (or of one row)


def _dealt(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Ids and texts dealt by id, to more tasks the more text there is: what a task holds
    of counted terms does not grow with the input, and a small file's rows go to all cores."""
    rows = df.select(id_col, text)
    n, chars = rows.select(F.count(F.lit(1)), F.coalesce(F.sum(F.length(text)), F.lit(0))).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(-(-chars // CHARS_A_TASK), min(2 * cores, -(-n // 200)), 1), id_col)


def word_terms(df: DataFrame, id_col: str, text: str, ngrams: tuple[int, int] = (1, 2),
               min_chars: int = 1) -> DataFrame:
    """(id, term) rows: lower-cased word n-grams (tokens = runs of word
    characters of at least ``min_chars``). Each text is tokenised once; all
    n-gram orders are generated from that one token array and exploded once."""
    pat = WORD_RE if min_chars <= 1 else r"[\p{L}\p{N}_]{%d,}" % min_chars
    # dealt by id before the terms are spread out: counting terms per id then needs no shuffle of its own
    toks = _dealt(df, id_col, text).select(id_col, F.regexp_extract_all(F.lower(F.col(text)), F.lit(pat), 0).alias("toks"))
    t = F.col("toks")
    arrays = []
    for n in range(ngrams[0], ngrams[1] + 1):
        if n == 1:
            arrays.append(t)
        elif n == 2:
            nxt = F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))
            arrays.append(F.filter(F.zip_with(t, nxt, lambda a, b: F.concat(a, F.lit(" "), b)),
                                   lambda x: x.isNotNull()))
        else:
            idx = F.sequence(F.lit(1), F.greatest(F.size(t) - n + 1, F.lit(0)))
            arrays.append(F.filter(F.transform(idx, lambda i, n=n: F.array_join(F.slice(t, i, n), " ")),
                                   lambda x: F.size(F.split(x, " ")) == n))
    terms = arrays[0] if len(arrays) == 1 else F.concat(*arrays)
    return toks.select(id_col, F.explode(terms).alias("term"))


def char_ngrams_sql(text: str, lo: int, hi: int) -> str:
    """SQL of the array of all character n-grams of an expression. The
    characters are bound to a lambda variable, so the text is computed and
    split once per row, and a gram costs its own length only."""
    chars = f"filter(split({text}, ''), c -> c <> '')"
    grams = ", ".join(
        f"if(size(cs) >= {n}, transform(sequence(1, size(cs) - {n - 1}), i -> array_join(slice(cs, i, {n}), '')), array())"
        for n in range(lo, hi + 1))
    return f"flatten(transform(array({chars}), cs -> flatten(array({grams}))))"


def char_terms(df: DataFrame, id_col: str, text: str, ngrams: tuple[int, int] = (3, 5)) -> DataFrame:
    """(id, term) rows of character n-grams of the lower-cased,
    white-space-normalised text (n-grams span spaces)."""
    norm = f"regexp_replace(lower(`{text}`), '(?U)\\\\s\\\\s+', ' ')"
    return _dealt(df, id_col, text).select(id_col, F.explode(F.expr(char_ngrams_sql(norm, *ngrams))).alias("term"))


def vocabulary(df: DataFrame, tokens: str, max_terms: int = 120_000, min_df: int = 1) -> DataFrame:
    """(term, cf, df): the ``max_terms`` most frequent terms of a token array column (by
    occurrences in all rows, ties in term order) among those of ``min_df`` rows or
    more. Counts are exact, by one aggregate that is
    combined before its shuffle."""
    def marked(terms, occurrence: int, row: int):
        return F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(occurrence).alias("n"), F.lit(row).alias("r")))

    each = F.concat(marked(F.col(tokens), 1, 0), marked(F.array_distinct(tokens), 0, 1))
    counts = df.select(F.explode(each).alias("x")).groupBy("x.term").agg(F.sum("x.n").alias("cf"), F.sum("x.r").alias("df"))
    return most_frequent(counts, max_terms, min_df)


def most_frequent(counts: DataFrame, max_terms: int, min_df: int) -> DataFrame:
    """Of (term, cf, df) the ``max_terms`` of the greatest cf, ties in term order, among those of ``min_df`` rows or more."""
    return counts.where(F.col("df") >= min_df).orderBy(F.col("cf").desc(), "term").limit(max_terms)


BROADCAST_TERMS = 1_000_000


def tfidf(terms: DataFrame, id_col: str, n_docs: Column, min_df: int = 1,
          max_features: int | None = None) -> DataFrame:
    """Smooth TF-IDF with L2 row normalisation:
    idf = ln((1 + n) / (1 + df)) + 1, w = tf * idf / ||tf * idf||.

    tf per (doc, term) comes from a combined aggregate. A vocabulary of up to
    ``BROADCAST_TERMS`` terms (estimated) is counted and broadcast; of a larger one every
    term's rows are counted in one shuffle by term, and nothing is joined.
    ``max_features`` keeps the most frequent terms (ties by term), by a distributed sort + limit."""
    tf = terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    idf = F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1
    if not max_features and terms.select(F.approx_count_distinct("term")).first()[0] > BROADCAST_TERMS:
        w = tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("term"))).where(F.col("df") >= min_df)
        w = w.repartition(id_col).withColumn("idf", idf)      # weights are made behind the shuffle
    else:
        df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")).filter(F.col("df") >= min_df)
        if max_features:
            df_ = df_.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features)
        vocab = df_.select("term", "df", idf.alias("idf")).checkpoint(eager=True)
        if vocab.count() <= BROADCAST_TERMS:      # counted, about 60 bytes a term: (id, term) rows stay where they are
            vocab = F.broadcast(vocab)
        w = tf.join(vocab, "term")
    w = w.withColumn("raw", F.col("tf") * F.col("idf"))
    # per-document norm as a window: one shuffle by document (a document's
    # terms are bounded by its length), and a following per-document
    # aggregate reuses that partitioning
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", "tf", "df", "idf", (F.col("raw") / norm).alias("weight"))
