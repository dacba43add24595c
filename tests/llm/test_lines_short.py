"""Line dedup: the bound on characters is of the whole run, not of each pair of lines."""
from collections import Counter

from pyspark.sql import functions as F

from citesight.llm import lines


def kept(spark, docs):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return [r.text for r in lines.dedup_lines(d).orderBy("doc_id").collect()]


def test_run_of_short_lines_goes(spark):
    menu = "\n".join(f"dish {i} {i * 37 % 101}" for i in range(100))
    assert kept(spark, [f"one head\n{menu}\none end", f"two head\n{menu}\ntwo end", f"{menu}\nthree end"]) == [
        f"one head\n{menu}\none end", "two head\ntwo end", "three end"]


def test_double_spaced_run_goes(spark):
    verse = "\n\n".join(f"a verse line of 35 characters no {i:02d}" for i in range(20))
    assert kept(spark, [f"one\n{verse}", f"two\nmore\n{verse}\nend"]) == [f"one\n{verse}", "two\nmore\nend"]


def test_short_run_under_the_bound_stays(spark):
    docs = ["a\nred\ngreen\nblue\nb", "c\nred\ngreen\nblue\nd", "\n\n\n\n", "\n\n\n\n\n"]
    assert kept(spark, docs) == docs


def test_equal_short_lines_in_one_document(spark):
    verse = "\n".join(["la la la"] * 3000)
    assert kept(spark, [verse, "x\n" + verse]) == ["la la la", "x"]


def test_sql_finds_the_same_runs(spark):
    """The query's SQL on short, blank, long and equal lines."""
    import duckdb
    import numpy as np
    rng = np.random.default_rng(11)
    words = ["", "", "la", "red fish", "a line of some length here", "x" * 45, "y" * 210, "blue", "one two three"]
    block = ["\n".join(rng.choice(words, rng.integers(1, 12))) for _ in range(12)]
    rows = [(int(i) if rng.random() < .95 else None, "\n".join([f"own {i}", *rng.choice(block, rng.integers(0, 6))])) for i in range(80)]
    rows += [(3, None), (4, ""), (5, rows[5][1]), (5, rows[5][1]), (200, "\n".join(["la la"] * 300))]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = Counter(con.execute(f"SELECT doc_id, n_lines, n_deleted, kept_sha256 FROM ({lines.ORACLE_SQL})").fetchall())
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    got = Counter(map(tuple, out.select("doc_id", "n_lines", "n_deleted", kept).collect()))
    assert got == want and sum(n for _, _, n, _ in got.elements()) > 200
