"""op6: a phrase repeated within a text is one place of it, not one place a repeat."""
import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from citesight.llm import catalog, suffixes


def test_copies_within_one_text():
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", dtype=np.uint8)
    own, passage = rng.choice(letters, 700).tobytes(), rng.choice(letters, 900).tobytes()
    for raw in (b"", own, own + b"so it is. " * 200 + own[:50], b"z" * 3000, passage + own + passage, passage * 3):
        found = suffixes.anchors(np.frombuffer(raw, dtype=np.uint8), suffixes._Powers())
        keep, start, end = suffixes.copies_within(raw, found)
        count = Counter(raw[i:i + 400] for i in range(len(raw) - 399))
        one, covered = Counter(), np.zeros(len(raw), dtype=bool)
        for a, z in zip(found[2][keep].tolist(), found[3][keep].tolist()):
            one.update(raw[i:i + 400] for i in range(a, z + 1))
        assert set(one) == set(count)  # every string has a place, for those of other texts
        for a, z in zip(start.tolist(), end.tolist()):
            assert all(count[raw[i:i + 400]] > 1 for i in range(a, z - 399))
            covered[a:z] = True
        left = [i for i in range(len(raw) - 399) if count[raw[i:i + 400]] > 1 and not covered[i:i + 400].all()]
        assert all(one[raw[i:i + 400]] > 1 for i in left)  # still met twice by what is kept
        assert (start[1:] > end[:-1]).all()


def test_repeated_phrase_gives_few_rows(spark, monkeypatch):
    monkeypatch.setattr("citesight.llm.suffixes.HOT", 10)
    made, write = [], suffixes.materialize

    def counted(df):
        out = write(df)
        made.append((out.columns, out.count()))
        return out

    monkeypatch.setattr("citesight.llm.suffixes.materialize", counted)
    rng = np.random.default_rng(6)
    word = lambda n: rng.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", dtype=np.uint8), n).tobytes().decode()
    texts = [word(60) + "as was said. " * 150 + word(60) for _ in range(30)]
    texts += ["only here " * 90, "q" * 1500, word(500), texts[0], None]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.remove_repeats(docs)
    raws = [(x or "").encode() for _, x in rows]
    count = Counter(b[i:i + 400] for b in raws for i in range(len(b) - 399))
    want = Counter()
    for (i, _), b in zip(rows, raws):
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - 399):
            if count[b[k:k + 400]] > 1:
                gone[k:k + 400] = True
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        want[i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())) == want
    assert got.where(F.col("doc_id") == 30).first().n_removed == 900  # repeats only within itself
    hot = [n for columns, n in made if "d1" in columns and "rid" in columns]
    assert hot and max(hot) <= 8 * len(rows)


def test_query_returns_the_size_that_is_left(spark, tmp_path):
    same = "abcdefghij klmnopqrst " * 30
    spark.createDataFrame([(1, same + "x"), (2, "y" + same), (3, "short"), (4, None)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in catalog.op6_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {i: (r.n_bytes, r.n_removed, r.kept_bytes) for i, r in got.items()} == {
        1: (661, 660, 1), 2: (661, 660, 1), 3: (5, 0, 5), 4: (0, 0, 0)}
