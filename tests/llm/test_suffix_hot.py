"""op6: what one task gets of a hot class is bounded, whatever follows the shared passage."""
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from citesight.llm import suffixes


def shared_passages(texts, before, after):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", dtype=np.uint8)
    passage = rng.choice(letters, 520).tobytes()
    return [rng.choice(letters, before).tobytes() + passage + rng.choice(letters, after).tobytes() for _ in range(texts)]


def test_contexts_of_one_key_are_bounded():
    hot, powers = 10, suffixes._Powers()
    raws = shared_passages(60, 300, 300)
    found = [[dict(zip(("key", "a", "p0", "p1"), map(int, x))) for x in zip(*suffixes.anchors(
        np.frombuffer(b, dtype=np.uint8), powers))] for b in raws]
    n = Counter(x["key"] for places in found for x in places)
    distinct = defaultdict(set)
    for b, places in zip(raws, found):
        for x in places:
            x["hot"] = n[x["key"]] > hot
        for key, _, _, ctx in suffixes.contexts(b, places):
            distinct[key].add(ctx)
    assert max(n.values()) > hot >= max(map(len, distinct.values()))
    strings = [[(p + i, 1) for p, k in suffixes.hot_parts(places) for i in range(k)] for places in found]
    digests = Counter(tuple(d) for b, own in zip(raws, strings) for d in suffixes.digests(b, own).tolist())
    assert sum(k == len(raws) for k in digests.values()) == 520 - 400 + 1


def test_hot_passage_is_removed_to_the_byte(spark, monkeypatch):
    monkeypatch.setattr("citesight.llm.suffixes.HOT", 10)
    raws = shared_passages(40, 130, 10)
    docs = spark.createDataFrame([(i, b.decode()) for i, b in enumerate(raws)], "doc_id long, text string")
    got = suffixes.remove_repeats(docs).select("n_removed", "n_spans", F.decode("kept", "utf-8").alias("kept"), "doc_id").collect()
    count = Counter(b[i:i + 400] for b in raws for i in range(len(b) - 399))
    for r in got:
        gone = np.zeros(len(raws[r.doc_id]), dtype=bool)
        for k in range(len(gone) - 399):
            gone[k:k + 400] |= count[raws[r.doc_id][k:k + 400]] > 1
        assert (r.n_removed, r.n_spans) == (gone.sum(), 1) and gone.sum() >= 520
        assert r.kept.encode() == np.frombuffer(raws[r.doc_id], dtype=np.uint8)[~gone].tobytes()
