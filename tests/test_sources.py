"""Scans, sinks and the whole-run pipeline."""

from citesight import presets
from citesight.plans import pipelines as pl
from citesight.sources import read_table, read_text_table, schemas, standin, write_table, write_text_table
from conftest import SF_SMALL


def test_latin1_multiline_csv(spark, tmp_path):
    p = tmp_path / "narr.csv"
    p.write_bytes('FACID,NARRATIVE\n1,"R\xe9sum\xe9 line one\nline two"\n2,plain\n'.encode("latin-1"))
    df = read_text_table(spark, str(p), "FACID string, NARRATIVE string", partitions=2)
    got = {r.FACID: r.NARRATIVE for r in df.collect()}
    assert got["1"] == "Résumé line one\nline two" and got["2"] == "plain"


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_table(df, str(tmp_path / "t"), partition_by=["k"])
    back = read_table(spark, str(tmp_path / "t"), columns=["k", "v"])
    assert sorted((r.k, r.v) for r in back.collect()) == [("a", 1), ("b", 2)]
    write_text_table(df, str(tmp_path / "c"))
    back = read_table(spark, str(tmp_path / "c"), "k string, v int", fmt="csv")
    assert back.count() == 2
    assert back.columns == ["k", "v"]
    assert len(back.limit(3).collect()) == 2


def test_run_pipeline(spark, tmp_path):
    enf = standin.raw_enforcement(spark, SF_SMALL)
    lk = standin.raw_lookup(spark, SF_SMALL)
    narr = standin.raw_narratives(spark, SF_SMALL)
    preset = dict(presets.STANDIN)
    out = pl.run_pipeline(spark, enf, lk, narr, str(tmp_path / "out"), preset)
    assert out["enriched_mart"].count() == enf.count()
    sel = out["inspection_list"].collect()
    assert 0 < len(sel) <= presets.INSPECTION_SLOTS
    imp = out["attribution"].collect()
    assert {r.stratum for r in imp} == {presets.STRATUM_HOSPITAL, presets.STRATUM_LTC}
    assert out["fact_ltc_narratives"].columns == schemas.STORED_NARRATIVES.fieldNames()
    assert out["fact_ltc_narratives"].count() == narr.count()
    v = out["validation"].first()
    assert v.row_count == out["fact_enforcement_actions"].count() and v.distinct_keys > 0
    assert out["preview"].count() == 3
    assert out["dim_fac_code"].columns == ["VARIABLE", "VALUE", "DESCRIPTION", "DEFINITION", "IS_24HR",
                                           "IS_HOSPITAL", "IS_LOW_RESOURCE"]
    assert out["dim_class_final"].columns == ["VARIABLE", "VALUE", "DESCRIPTION"]


def test_read_inputs_from_csv_exports(spark, tmp_path):
    enf = tmp_path / "enf.csv"
    enf.write_text(" facid ,PENALTY_NUMBER,Class_Assessed_Final,APPEALED,TOTAL_BALANCE_DUE,PRIORITY_ALL\n"
                   "010000001, 7 ,B Trebled,Yes,12.50,\"C, A\"\n"
                   "2,8,AA,No,bad,\n")
    lk = tmp_path / "lk.csv"
    lk.write_text("VARIABLE,VALUE,DESCRIPTION,DEFINITION\nVARIABLE,VALUE,DESCRIPTION,DEFINITION\n"
                  "FAC_TYPE_CODE,GACH,General,duly constituted governing body\n")
    narr = tmp_path / "narr.csv"
    narr.write_bytes('FACID,FACILITY_NAME,NARRATIVE\n1,o\'brien\'s home,"F123 Caf\xe9 (x)\nline"\n'.encode("latin-1"))
    e, lkp, n = pl.read_inputs(spark, str(enf), str(lk), str(narr))
    rows = {r.FACID: r for r in e.collect()}
    assert str(rows["010000001"].TOTAL_BALANCE_DUE) == "12.50"
    assert rows["2"].TOTAL_BALANCE_DUE is None and rows["2"].PRIORITY_ALL is None
    assert e.columns[:2] == ["EVENTID", "FACID"]
    clean = {r.FACID: r for r in pl.clean_enforcement(e).collect()}
    assert clean["010000001"].CLASS_ASSESSED_FINAL == "B TREBLED" and clean["010000001"].HIGHEST_PRIORITY == 1
    assert pl.clean_lookup(lkp).count() == 1
    nn = pl.clean_narratives(n).first()
    assert nn.FACILITY_NAME == "O'Brien'S Home" and nn.NARRATIVE_CLEAN == "café line"
