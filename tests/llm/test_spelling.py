"""Spelling variants against all pairs of words."""
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from citesight.llm import spelling as s


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(n, factor=5):
    out = []
    best = {}
    for w in n:
        nb = [x for x in n if near(w, x)]
        top = min(nb, key=lambda x: (-n[x], x), default=None)
        best[w] = (len(nb), top if top is not None and n[top] >= factor * n[w] else None)
    for w in n:
        root = w
        while best[root][1] is not None:
            root = best[root][1]
        out.append((w, best[w][1], root, n[w], best[w][0], n.get(best[w][1])))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def vocabulary(seed, size, letters="abcé"):
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(list(letters), rng.integers(1, 6))) for _ in range(size)}
    return {w: int(5 ** rng.integers(0, 7)) + int(rng.integers(0, 3)) for w in words} | {"a" * 90: 3, "a" * 91: 40, "a" * 89 + "b": 7, "\U0001f600a": 2}


@pytest.mark.parametrize("rounds", [False, True])
def test_equals_all_pairs(spark, monkeypatch, rounds):
    n = vocabulary(1, 400)
    if rounds:
        monkeypatch.setattr(s, "PROBES", 7)  # places and words in many blocks
    df = spark.createDataFrame(sorted(n.items()), "word string, n long").repartition(3)
    assert got(s.group_variants(df, filter_bytes=64 if rounds else s.FILTER_BYTES)) == brute(n)


def test_every_pair_comes_once(spark):
    n = vocabulary(2, 300)
    pairs = s.near_pairs(spark.createDataFrame(sorted(n.items()), "word string, n long")).collect()
    seen = Counter(frozenset((r.word, r.near)) for r in pairs)
    assert set(seen.values()) == {1} and set(seen) == {frozenset((a, b)) for a in n for b in n if near(a, b)}
    assert all(r.n == n[r.word] and r.near_n == n[r.near] for r in pairs)


def test_corpus_words(spark):
    rows = [(i, f"Straße Éclair{i} garçon-Café NAÏVEté abcdef abcdefg éé ×÷×÷×÷ x1abcdefgh\n" * 3) for i in range(60)]
    rows += [(None, "Garçonette plus"), (7, None), (7, ""), (7, "Repeated repeated"), (7, "Repeated repeated")]
    want = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run
            want.update([word] * (len(word) >= 6))
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    words = s.corpus_words(df)
    assert Counter(r.word for r in words.collect()) == want
    assert {r.word: r.n for r in s.vocabulary(words).collect()} == {w: c for w, c in want.items() if c >= 5}


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert got(s.group_variants(s.vocabulary(s.corpus_words(empty)))) == []
    one = spark.createDataFrame([("alone", 9)], "word string, n long")
    assert got(s.group_variants(one)) == [("alone", None, "alone", 9, 0, None)]
