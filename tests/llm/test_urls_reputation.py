"""URL filters where hosts differ: the posterior, not a rule, blocks; its SQL agrees."""
import duckdb
import numpy as np
from pyspark.sql import functions as F

from citesight.llm import urls


def table(seed=3):
    """Hosts of three kinds: bad, clean, and with one bad page."""
    rng = np.random.default_rng(seed)
    pages, labels = [], []
    for k in range(30):
        for host, rate, n in ((f"bad{k}.spam.com", .9, 40), (f"good{k}.fine.co.uk", .05, 40), (f"small{k}.fair.de", .1, 2)):
            for _ in range(n):
                i = len(pages)
                pages.append((i, f"https://{host}/p{i}"))
                if rng.random() < .8:
                    labels.append((i, int(rng.random() >= rate), 0))
    pages += [(10_000, None), (10_001, "https://new.spam.com/"), (10_002, "https://unseen.example.fr/"), (10_001, "https://new.spam.com/")]
    labels += [(0, 0, 0), (0, 1, 1), (None, 0, 0)]
    return pages, labels


def test_bad_hosts_are_blocked_and_clean_ones_left_alone(spark):
    pages, labels = table()
    p = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash"))
    seen = spark.createDataFrame(labels, "page_id long, quality int, toxic int").select(
        "page_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    out = urls.filter_urls(p, seen).collect()
    verdict = {}
    for r in out:
        verdict.setdefault(r.host, set()).add(r.verdict)
    assert all(v == ({"block"} if ".spam.com" in h else {"allow"}) for h, v in verdict.items()), verdict
    assert all(r.rule is None for r in out) and len(out) == len(pages)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    want = con.execute(f"SELECT page_id, host, verdict, bad_lower FROM ({urls.ORACLE_SQL})").fetchall()
    key = lambda r: (r[0], r[1], r[2], round(r[3], 5))
    assert sorted(map(key, want)) == sorted(key((r.page_id, r.host, r.verdict, r.bad_lower)) for r in out)


def test_without_labels_nothing_is_blocked(spark):
    pages, _ = table()
    p = spark.createDataFrame(pages, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    assert {r.verdict for r in urls.filter_urls(p, none).select("verdict").distinct().collect()} == {"allow"}
    assert urls.filter_urls(p.limit(0), none).count() == 0
