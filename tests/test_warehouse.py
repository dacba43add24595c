"""Named tables, replaced as a whole; typed scans; the resumable run."""
import pytest
from pyspark.sql import functions as F

from citesight import presets
from citesight.operators import joins, profile
from citesight.plans import pipelines as pl
from citesight.sources import schemas, standin
from citesight.sources.typed import RESCUED, count_rejects, reject_report, typed_scan
from citesight.sources.warehouse import Warehouse, content_digest
from conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "named")
    first = wh.replace("t", spark.range(5).withColumn("k", F.col("id") % 2), key="k", buckets=2)
    assert rows(first) == rows(wh.table("t")) == rows(spark.table("named.t"))
    bad = spark.range(100).withColumn("k", F.when(F.col("id") == 77, F.raise_error(F.lit("killed")).cast("long")).otherwise(1))
    with pytest.raises(Exception, match="killed"):
        wh.replace("t", bad, key=None)
    assert rows(wh.table("t")) == rows(spark.table("named.t")) == [(i, i % 2) for i in range(5)]
    assert rows(Warehouse(spark.newSession(), str(tmp_path)).table("t")) == [(i, i % 2) for i in range(5)]
    wh.replace("t", spark.range(3).withColumn("other", F.lit("x")))
    assert spark.table("named.t").columns == ["id", "other"] and wh.table("t").count() == 3
    assert wh.vacuum("t") >= 2 and wh.table("t").count() == 3
    with pytest.raises(ValueError, match="no table"):
        wh.table("u")


def test_clustered_tables_need_no_exchange(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    mart = wh.replace("mart", pl.standin_mart(spark, SF_SMALL), key="FACID", buckets=4, schema=schemas.MART)
    assert wh.current("mart")["key"] == "FACID"
    flagged = pl.penalty_features(mart, presets.STANDIN)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    prof = profile.facility_profile(flagged, presets.STANDIN["ltc_profile"])
    info = joins.first_per_key(mart, "FACID", pl.FIRST_ORDER, ["FACILITY_NAME"])
    for df in (prof, info, prof.join(info, "FACID"), mart.groupBy("FACID", "EVENTID").agg(F.min("PENALTY_ISSUE_DATE"))):
        assert "Exchange" not in plan(df), plan(df)
    assert rows(info) == rows(joins.first_per_key(pl.standin_mart(spark, SF_SMALL), "FACID", pl.FIRST_ORDER, ["FACILITY_NAME"]))


def test_a_hot_key_is_not_made_one_bucket(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    df = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    assert wh.replace("t", df, key="k", buckets=64).count() == 3000 and wh.current("t")["key"] is None
    assert wh.replace("t", df, key="k", buckets=4).count() == 3000 and wh.current("t")["key"] == "k"
    assert wh.replace("e", df.limit(0), key="k").count() == 0


def test_schemas_are_checked(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    with pytest.raises(ValueError, match="FACID: missing"):
        wh.replace("m", pl.standin_mart(spark, SF_SMALL).drop("FACID"), schema=schemas.MART)
    with pytest.raises(ValueError, match="EVENTID: bigint"):
        schemas.check_schema(pl.standin_mart(spark, SF_SMALL).withColumn("EVENTID", F.lit(1).cast("long")), schemas.MART)
    assert schemas.check_schema(pl.standin_mart(spark, SF_SMALL), schemas.MART).columns == schemas.MART.fieldNames()


def test_rejects_are_kept_and_counted(spark, tmp_path):
    schema = "a string, n string, other string"
    raw = spark.createDataFrame([("1", "2.5", "x"), ("2", "bad", "x"), ("3", None, "x"), ("4", "  ", None), ("5", "bad", "y")], schema)
    kinds = schemas._schema([("a", schemas.S), ("n", schemas.D), ("missing", schemas.I)])
    typed = typed_scan(raw, kinds, required=("a",))
    assert typed.columns == ["a", "n", "missing", RESCUED]
    assert {r.a: dict(r[RESCUED]) for r in typed.collect()} == {"1": {}, "2": {"n": "bad"}, "3": {}, "4": {}, "5": {"n": "bad"}}
    assert rows(reject_report(typed)) == [("n", 2, 1)]
    out, seen = count_rejects(typed, ["n"])
    out.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"rows": 5, "n": 2} and RESCUED not in out.columns
    with pytest.raises(ValueError, match="missing columns: missing"):
        typed_scan(raw, kinds, required=("missing",))
    assert typed_scan(raw.limit(0), kinds).count() == 0


def test_content_digest(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    assert content_digest(df) == content_digest(df.repartition(3)) == content_digest(df.orderBy(F.desc("i")))
    assert len({content_digest(x) for x in (df, df.distinct(), df.union(df), df.limit(0), df.withColumnRenamed("s", "t"))}) == 5


def test_dimension_keys_that_repeat_raise(spark, tmp_path):
    enf, lk = standin.raw_enforcement(spark, SF_SMALL), standin.raw_lookup(spark, SF_SMALL)
    twice = lk.unionByName(lk.where("VARIABLE = 'FAC_TYPE_CODE'").limit(1))
    with pytest.raises(ValueError, match="1 facility types and 0 classes"):
        pl.run_pipeline(spark, enf, twice, None, str(tmp_path), presets.STANDIN)
    clean = pl.clean_enforcement(enf, presets.STANDIN)
    proofs = pl.mart_proofs(clean, *pl.dims(pl.clean_lookup(twice))).first()
    mart = joins.enrich_mart(clean, *pl.dims(pl.clean_lookup(twice)))
    assert proofs.repeated_types == 1 and proofs.mart_rows == mart.count() > proofs.fact_rows == enf.count()
    assert proofs.type_unknown + proofs.type_missing == pl.standin_mart(spark, SF_SMALL).where("FACILITY_TYPE_DESC IS NULL").count()
    empty = pl.mart_proofs(clean.limit(0), *pl.dims(pl.clean_lookup(lk.limit(0)))).first()
    assert empty.fact_rows == empty.mart_rows == empty.repeated_types == 0


def test_a_run_is_taken_up_where_it_ended(spark, tmp_path, monkeypatch):
    enf, lk = standin.raw_enforcement(spark, SF_SMALL), standin.raw_lookup(spark, SF_SMALL)
    preset, root = dict(presets.STANDIN), str(tmp_path)
    wh = Warehouse(spark, root)
    whole = ["fact_enforcement_actions", "dim_fac_code", "dim_class_final", "enriched_mart", "inspection_list", "attribution"]

    def versions():
        return {n: (wh.current(n) or {}).get("version") for n in whole}
    real = pl.inspection_list
    monkeypatch.setattr(pl, "inspection_list", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        pl.run_pipeline(spark, enf, lk, None, root, preset)
    first = versions()
    assert [n for n in whole if first[n] is None] == ["inspection_list", "attribution"]
    monkeypatch.setattr(pl, "inspection_list", real)
    out = pl.run_pipeline(spark, enf, lk, None, root, preset)
    second = versions()
    assert all(second[n] == first[n] for n in whole[:4]) and None not in second.values()
    rejects = {r.column: r.rejected for r in out["rejects"].collect()}
    assert rejects["PENALTY_ISSUE_DATE"] == enf.where("PENALTY_ISSUE_DATE = '31/31/2020'").count() > 0
    assert rejects["TOTAL_BALANCE_DUE"] == 0 and out["validation"].first().fact_rows == enf.count()
    monkeypatch.setattr(pl, "score_facilities", lambda *a, **k: pytest.fail("nothing is to be made"))
    pl.run_pipeline(spark, enf, lk, None, root, preset)
    assert versions() == second
    monkeypatch.undo()
    other = lk.withColumn("DEFINITION", F.concat("DEFINITION", F.lit(" (community)")))
    pl.run_pipeline(spark, enf, other, None, root, preset)
    third = versions()
    assert third["fact_enforcement_actions"] == second["fact_enforcement_actions"]
    assert all(third[n] != second[n] for n in whole[1:])
