"""Term counts: what is shuffled, and documents of many rows."""
from collections import Counter

from citesight.operators import keywords as kw


def narratives(spark):
    rows = [(str(i), f"leaky pipe number{i % 7} leaky valve") for i in range(60)]
    rows += [("hot", f"broken door word{i % 3}") for i in range(200)] + [(None, "broken lamp"), (None, "broken lamp"), ("none", None)]
    return spark.createDataFrame(rows, "FACID string, TEXT string").repartition(5)


def test_terms_are_counted_without_a_second_exchange(spark):
    plan = kw.term_counts(narratives(spark), "FACID", "TEXT")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(FACID" in plan and ", term" not in "".join(x for x in plan.splitlines() if "Exchange hash" in x)


def test_a_document_of_many_rows_stays_spread(spark, monkeypatch):
    even = {(r.FACID, r.term, r.tf) for r in kw.term_counts(narratives(spark), "FACID", "TEXT").collect()}
    assert ("hot", "broken door", 200) in even and (None, "lamp", 2) in even
    monkeypatch.setattr(kw, "TEXTS_A_TASK", 10)
    monkeypatch.setattr(kw, "MAX_SKEW", 2)
    df = narratives(spark)
    assert kw.by_document(df, "FACID") is df
    assert {(r.FACID, r.term, r.tf) for r in kw.term_counts(df, "FACID", "TEXT").collect()} == even


def test_weights_keep_the_counts(spark):
    got = {(r.FACID, r.term): r.tf for r in kw.tfidf(narratives(spark), "FACID", "TEXT", size=5).collect()}
    total = Counter()
    for (_, term), n in {(r.FACID, r.term): r.tf for r in kw.term_counts(narratives(spark), "FACID", "TEXT").collect()}.items():
        total[term] += n
    top = sorted(total, key=lambda t: (-total[t], t))[:5]
    assert {t for _, t in got} == set(top) and got["hot", "broken"] == 200
