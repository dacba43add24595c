"""Collocations against plain counting, and their index against plain search."""
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from citesight.llm import collocations as c


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, min_count, depth=3, top=2000, cover=50):
    f = defaultdict(Counter)
    for text, lang in rows:
        for w in pieces(text):
            for m in range(1, depth + 1):
                f[lang or "und"].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, n in f.items():
        total = sum(v for p, v in n.items() if len(p) == 1)
        wide = {p: a for p, a in n.items() if len(p) > 1 and a >= min_count}
        hidden = {p[i:j] for p, a in wide.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and p[i:j] in wide and 100 * a >= cover * wide[p[i:j]]}
        best = []
        for p, a in wide.items():
            if p not in hidden:
                score, k = min((1000000 * a * a // (n[p[:k]] * n[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total, -s) for i, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(out)


def got(df, **how):
    return sorted(tuple(r) for r in c.collocations(df, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def sample(seed, n):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "c", "Dé", "é", "\x00", "zz\xa0z", "…"]
    ends = [" ", "  ", "\t", ", ", ".", "\n", " ; ", " "]
    said = lambda k: "".join(x for _ in range(k) for x in (rng.choice(words, p=[.3, .2, .1, .1, .1, .05, .1, .05]), rng.choice(ends, p=[.5, .1, .1, .1, .05, .05, .05, .05])))
    rows = [(said(rng.integers(0, 60)), str(rng.choice(["en", "de"]))) for _ in range(n)]
    return rows + [(None, "en"), ("", "en"), ("a B a B", None), ("a b", "und"), (" ., ", "xx"), rows[0], rows[0]]


@pytest.mark.parametrize("how", ["plain", "cut", "narrow", "deep"])
def test_equals_counting(spark, monkeypatch, how):
    rows = sample(1, 200)
    schema = "text string, lang string"
    if how == "cut":  # shards of a few words, so every text is cut and words are carried over
        monkeypatch.setattr(c, "SHARD_BYTES", 9)
        monkeypatch.setattr(c, "HELD_BYTES", 20)
    if how == "narrow":  # few buckets: less is left out, nothing is lost
        monkeypatch.setattr(c.phrase_counts, "__defaults__", (3, 10, 4))
    depth = 5 if how == "deep" else 3
    df = spark.createDataFrame(rows, schema).repartition(5)
    assert got(df, min_count=4, max_words=depth) == brute(rows, 4, depth)
    assert got(df, min_count=4, max_words=depth, top=3) == brute(rows, 4, depth, top=3)


def test_nothing_and_clashing_columns(spark):
    assert got(spark.createDataFrame([], "text string, lang string")) == []
    assert got(spark.createDataFrame([(None, None)], "text string, lang string")) == []
    rows = sample(2, 30)
    df = spark.createDataFrame([(t, g, 1, "x", 2, 3, "y") for t, g in rows],
                               "text string, lang string, n int, phrase string, rank int, score int, `whole` string")
    assert got(df, min_count=3) == brute(rows, 3)


def test_large_counts_stay_exact(spark, monkeypatch):
    counts = spark.createDataFrame([("en", "", 0, 10 ** 13), ("en", "x", 1, 9 * 10 ** 12), ("en", "y", 1, 8 * 10 ** 12),
                                    ("en", "x y", 2, 7 * 10 ** 12 + 1)], "lang string, phrase string, m int, n long")
    monkeypatch.setattr(c, "phrase_counts", lambda *_: counts)
    a, left, right = 7 * 10 ** 12 + 1, 9 * 10 ** 12, 8 * 10 ** 12
    assert got(counts) == [("en", 1, "x y", a, left, right, 10 ** 13, 1000000 * a * a // (left * right))]


@pytest.mark.parametrize("depth", [1, 2, 3, 6])
def test_index_enumerates_every_phrase(depth):
    rng = np.random.default_rng(4)
    for top in (3, 50):
        words = np.concatenate([[0], *(np.concatenate([rng.integers(1, top, rng.integers(1, 9)), [0]]) for _ in range(40))])
        want = Counter(tuple(words[i:i + m].tolist()) for m in range(1, depth + 1) for i in range(len(words) - m + 1)
                       if (words[i:i + m] > 0).all())
        seen = {tuple(p): n for phrase, size in c.FmIndex(words, depth).phrases(depth) for p, n in zip(phrase.tolist(), size.tolist())}
        assert seen == dict(want)


def test_cut_carries_words_of_the_same_piece_only():
    text = b"one two three. four five six\nseven " + b"x" * 50 + b" eight"
    parts = [(t, n) for _, t, n in c.shards(iter([pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text.decode()]})]), 10, 100, 2)]
    assert [w for t, n in parts for w in t.replace(b".", b" ").split()[n:]] == text.replace(b".", b" ").split()
    carried = [t.replace(b".", b" ").split()[:n] for t, n in parts]
    assert carried[0] == [] and [b"two", b"three"] not in carried[2:] and [b"seven", b"x" * 50] in carried
    assert all(b"three" not in c and b"six" not in c for c in carried[1:] if b"four" in c or b"seven" in c)
