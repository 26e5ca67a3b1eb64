"""Hand-worked cases for the column functions (FIXTURES §3)."""

from pyspark.sql import functions as F

import sparkmart.functions as SF


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_str_to_num(spark):
    cases = {"1,234원": 1234.0, "4.567": 4.57, ".5": 0.5, "5.": None, "1.2.3": None, "abc": None, "": None,
             "2147483647": 0.0, "9" * 25: 0.0, None: None}
    for text, want in cases.items():
        assert one(spark, SF.str_to_num(F.col("s")), text) == want, text
    assert one(spark, SF.str_to_num(F.col("s"), scale=None), "4.567") == 4.567


def test_str_to_num_sql_function(spark):
    SF.register_str_to_num(spark)
    assert spark.sql("SELECT STR_TO_NUM('12%') AS r").first().r == 12.0


def test_num_only_and_digits_or_zero(spark):
    assert one(spark, SF.num_only(F.col("s")), "12,300원") == 12300
    assert one(spark, SF.num_only(F.col("s")), "무료") is None
    assert one(spark, SF.num_only(F.col("s")), "12.5") == 125
    assert one(spark, SF.digits_or_zero(F.col("s")), None) == 0
    assert one(spark, SF.digits_or_zero(F.col("s")), "-12%") == 12
    assert one(spark, SF.digits_or_zero(F.col("s")), "상담") == 0


def test_clean_text(spark):
    assert one(spark, SF.clean_text(F.col("s")), "  a\u00a0 b\n") == "a b"
    assert one(spark, SF.clean_text(F.col("s")), "   ") is None
    assert one(spark, SF.normalize_ws(F.col("s")), None) == ""


def test_time_range(spark):
    def parts(text):
        df = spark.createDataFrame([(text,)], "s string")
        st, en = SF.time_range_parts(SF.clean_time_range(F.col("s")))
        r = df.select(st.alias("a"), en.alias("b")).first()
        return r.a, r.b
    assert parts("9:05～10:20") == ("09:05:00", "10:20:00")
    assert parts("09:00\u00a0~\u200b10:00") == ("09:00:00", "10:00:00")
    assert parts("25:10~26:00") == (None, None)
    assert parts(SF.ON_AIR_TEXT) == (None, None)


def test_discount_rate_half_even(spark):
    df = spark.createDataFrame([(200, 199), (200, 195), (100, 120)], "l long, s long")
    got = [r.r for r in df.select(SF.discount_rate("l", "s").alias("r")).collect()]
    assert got == [0, 2, None]


def test_https_and_after_dot(spark):
    assert one(spark, SF.https(F.col("s")), "//x.com/a") == "https://x.com/a"
    assert one(spark, SF.https(F.col("s")), "") is None
    assert one(spark, SF.after_first_dot(F.col("s")), "img.v1.jpg") == "v1.jpg"
    assert one(spark, SF.after_first_dot(F.col("s")), "nodot") == "nodot"


def test_suffix_match(spark):
    assert one(spark, SF.token_suffix_match(F.col("s"), ["탕"]), "갈비탕,") is True
    assert one(spark, SF.token_suffix_match(F.col("s"), ["탕"]), "탕수육") is False
    assert one(spark, SF.token_suffix_match(F.col("s"), ["탕"]), "") is False


def test_url_parts(spark):
    r = one(spark, SF.url_parts(F.col("s")), "mysql+x://u:p%40@h/db/extra?a=&socket=s")
    assert (r.scheme, r.user, r.password, r.host, r.port, r.database) == ("mysql+x", "u", "p@", "h", 3306, "db")
    r = one(spark, SF.url_parts(F.col("s")), "u:p@h:1/db")
    assert (r.scheme, r.port, r.host, r.database) == ("dummy", 1, "h", "db")
    assert one(spark, SF.url_param(F.col("s"), "slitmCd"), "https://a/b?x=1&slitmCd=22") == "22"


def test_drop_first_and_sections(spark):
    assert one(spark, SF.drop_first_char(F.col("s"), "|"), "a|b|c") == "ab|c"
    assert one(spark, SF.section_tags_to_bar(F.col("s")), "[재료] a | [양념] b") == "|a||b"
