"""Scalar rules on tiny in-code frames (edge rows of FIXTURES.md)."""

from pyspark.sql import functions as F

from citesight import presets
from citesight.functions import (clean_text, collapse_ws, effective_class, highest_priority,
                                 parse_date, quota, recode, round_half_even, safe_div, strip_tabs,
                                 title_case, token_count, utrim)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_utrim_unicode_whitespace(spark):
    got = one(spark, [(" A\t",), (" B ",), ("A\tTrebled",), (None,)], "x string", utrim("x"))
    assert got == ["A", "B", "A\tTrebled", None]


def test_strip_tabs_inside(spark):
    got = one(spark, [("A\tTrebled",)], "x string", strip_tabs("x"))
    assert got == ["ATrebled"]


def test_recode_keep_and_null(spark):
    rows = [("B Trebled",), ("XYZ",), (None,)]
    keep = one(spark, rows, "x string", recode("x", presets.CLASS_FINAL_RECODE))
    assert keep == ["B TREBLED", "XYZ", None]
    death = one(spark, [("Y",), ("N",), ("y",)], "x string", recode("x", presets.DEATH_MAP, keep=False))
    assert death == [1, 0, None]


def test_death_fill_then_map(spark):
    filled = F.coalesce(F.col("x"), F.lit(presets.DEATH_FILL))
    got = one(spark, [("Y",), ("N",), (None,), ("y",)], "x string", recode(filled, presets.DEATH_MAP, keep=False))
    assert got == [1, 0, 0, None]


def test_effective_class(spark):
    rows = [("A", "B", "No"), ("A", "B", "Yes"), ("A", "B", None)]
    got = one(spark, rows, "i string, f string, a string", effective_class("i", "f", "a"))
    assert got == ["A", "B", "B"]


def test_priorities(spark):
    rows = [("C, A",), ("E",), ("Z",), ("A,,B",), (None,)]
    hp = one(spark, rows, "x string", recode(highest_priority("x", presets.PRIORITY_TOKENS),
                                             presets.PRIORITY_NUMBER, keep=False))
    cnt = one(spark, rows, "x string", token_count("x"))
    assert hp == [1, None, None, 1, None]
    assert cnt == [2, 1, 1, 3, 0]


def test_bad_date_is_null(spark):
    got = one(spark, [("31/31/2020",), ("2020-02-03",), ("02/03/2020",)], "x string",
              F.date_format(parse_date("x"), "yyyy-MM-dd"))
    assert got == [None, "2020-02-03", "2020-02-03"]


def test_title_case_python_rule(spark):
    got = one(spark, [("o'brien's 3rd st.",), ("UCSF medical LLC",)], "x string", title_case("x"))
    assert got == ["O'Brien'S 3Rd St.", "Ucsf Medical Llc"]


def test_narrative_codes(spark):
    got = one(spark, [("F1234 ART12 (x) 55 Résumé_1!",)], "x string", clean_text("x"))
    assert got == ["ar résumé_1"]


def test_rare_word_characters(spark):
    got = one(spark, [("x² ńa ½ 3rd 5² é1",)], "x string", clean_text("x"))
    assert got == ["x² n a ½ 3rd 5² é1"]


def test_null_narrative(spark):
    assert one(spark, [(None,)], "x string", clean_text("x")) == [""]


def test_collapse_ws(spark):
    assert one(spark, [("a \t\n b",)], "x string", collapse_ws("x")) == ["a b"]


def test_half_even_rounding(spark):
    got = one(spark, [(12.25,), (12.35,), (2.5,)], "x double",
              F.array(round_half_even("x", 1), round_half_even("x", 0)))
    assert [g[0] for g in got][:2] == [12.2, 12.4]
    assert got[2][1] == 2.0


def test_safe_div_zero(spark):
    got = one(spark, [(1, 0), (1, 4)], "a int, n int", safe_div("a", "n"))
    assert got == [None, 0.25]


def test_quota(spark):
    got = one(spark, [(0, 10), (10, 10), (1, 100), (0, 0)], "h long, t long", quota("h", "t", 25))
    assert got == [1, 25, 1, 1]


def test_plain_dates_need_no_formatter(spark):
    from citesight.functions import parse_date
    said = {"1/2/2020": "2020-01-02", "02/29/2020": "2020-02-29", "2/29/2021": None, "31/31/2020": None, "0/1/2020": None,
            "1/2/2020\n": None, " 20201231 ": "2020-12-31", "20201301": None, "20200101\n": None, "2020/1/2": "2020-01-02",
            "2020/02/30": None, "1/1/0000": "0000-01-01", "1/2/69": "1969-01-02", "1-2-2020": "2020-01-02", "1/2": None, "/": None}
    df = spark.createDataFrame(list(said.items()), "t string, want string").withColumn("d", parse_date("t"))
    got = {r.t: r.d for r in df.select("t", F.date_format("d", "yyyy-MM-dd").alias("d")).collect()}
    assert got == said
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "yyyyMMdd" not in plan and "yyyy/M/d" not in plan
