"""No caps or switches: quantile brackets, quotas, pivot values, dates, first
valid penalties, the shared folder."""
import pytest
from pyspark.sql import functions as F

from citesight import session
from citesight.functions import parse_date
from citesight.operators import aggregates, joins, quantiles, selection


def test_quantile_between_neighbouring_doubles(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 2)
    lo, hi = 1.0, 1.0000000000000002
    df = spark.createDataFrame([(lo,)] * 200 + [(hi,)] * 200, "x double")
    assert quantiles.exact_quantile(df, "x", 0.5) in (lo, hi)
    assert quantiles.exact_quantile(df, "x", 0.25) == lo
    assert quantiles.exact_quantile(df, "x", 0.9) == hi


def test_quota_above_25(spark):
    df = spark.range(60).select(F.col("id").alias("k"), F.col("id").cast("double").alias("s"), F.lit("a").alias("stratum"))
    quotas = spark.createDataFrame([("a", 40)], "stratum string, quota bigint")
    assert selection.top_k_strata(df, "s", quotas, "k").count() == 40
    with pytest.raises(ValueError):
        selection.top_k_strata(df, "s", quotas, "k", max_k=25)


def test_every_value_becomes_a_column(spark):
    df = spark.createDataFrame([(f"d{i % 3}", f"t{i % 6}") for i in range(36)], "d string, t string")
    for wide in (aggregates.crosstab(df, "d", "t"), aggregates.crosstab_share(df, "d", "t")):
        assert set(wide.columns) == {"d"} | {f"t{i}" for i in range(6)}


@pytest.mark.parametrize("text", ["2020-01-05", "1/5/2020", "01/05/2020", "2020-01-05T00:00:00", "2020-01-05 00:00:00.000",
                                  " 2020-01-05", "05-Jan-2020", "Jan 5, 2020", "JANUARY 5 2020", "2020-1-5", "1/5/2020 0:00"])
def test_lenient_dates(spark, text):
    df = spark.createDataFrame([(text,), ("soon",), (None,)], "t string")
    got = [str(r[0]) for r in df.select(parse_date("t").cast("string")).collect()]
    assert got == ["2020-01-05 00:00:00", "None", "None"]


def test_first_row_by_order_with_nulls_last(spark):
    df = spark.createDataFrame([("f", None, "1", "late"), ("f", 2, "2", "b"), ("f", 2, "1", "a")],
                               "k string, d int, n string, name string")
    assert joins.first_per_key(df, "k", ["d", "n"], ["name"]).collect()[0].name == "a"


def test_written_tables_can_be_dropped(spark):
    df = session.materialize(spark.range(5))
    assert df.count() == 5
    session.drop_materialized(spark)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0])


def test_missing_input_column_is_an_error(spark, tmp_path):
    from citesight.plans.pipelines import read_inputs
    p = str(tmp_path / "t.csv")
    with open(p, "w") as f:
        f.write("FACID,NOT_A_COLUMN\n1,2\n")
    with pytest.raises(ValueError, match="missing columns"):
        read_inputs(spark, p, p, required=("FACID", "PENALTY_NUMBER"))


def test_a_session_without_context_must_name_the_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Remote:
        conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Remote())
