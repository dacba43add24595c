"""Language ID: what the models and the calibration are made of."""
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from citesight.llm import langid


def test_every_count_stays_in_the_model(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_NGRAMS", 30, raising=False)  # no bound is read any more
    rows = [("the cat sat on the mat " * 50, "en")] * 4 + [("zwei kleine hunde", "de")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = langid.fit(docs)
    assert model["langs"] == ["de", "en"]
    n = {lang: p["n3"] for lang, p in zip(model["langs"], model["parts"])}
    assert len(n["de"]) == len(set(langid._trigrams([(0, rows[-1][0], False)], model["table"])[0].tolist()))
    assert (n["de"] == 1).any() and np.isfinite(model["heat"])
    got = langid.identify(docs.select("text"), model, []).collect()
    assert sorted(r.lang_pred for r in got) == ["de"] + ["en"] * 4


def kneser_ney(texts):
    """Interpolated Kneser-Ney trigrams by dictionaries: (u, v, w) -> probability."""
    table = langid.letter_table()
    three = Counter()
    for t in texts:
        s = [langid.START] * 2
        for c in t:
            x = int(table[min(ord(c), langid._TABLE)])
            if x != langid.SPACE or len(s) == 2 or s[-1] != langid.SPACE:
                s.append(x)
        three.update(zip(s, s[1:], s[2:]))
    two, one = Counter(), Counter()
    for _, v, w in three:
        two[v, w] += 1
    for _, w in two:
        one[w] += 1

    def discount(n):
        a, b = (sum(v == k for v in n.values()) for k in (1, 2))
        return a / (a + 2 * b) if a and b else 0.5
    d3, d2, d1 = discount(three), discount(two), discount(one)
    symbols = len({w for *_, w in three}) + 1

    def level(n, d, context, w, below):
        own = {k: v for k, v in n.items() if k[:-1] == context}
        total = sum(own.values())
        return (max(n.get((*context, w), 0) - d, 0) + d * len(own) * below) / total if total else below

    def p(u, v, w):
        lowest = max(one.get(w, 0) - d1, 0) / sum(one.values()) + d1 * len(one) / sum(one.values()) / symbols
        return level(three, d3, (u, v), w, level(two, d2, (v,), w, lowest))
    return three, symbols, p


def test_estimates_equal_a_dictionary_model(spark):
    texts = ["the cat sat on the mat", "a mat, a hat; the END!", "no cat  is a hat"]
    model = langid.fit(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"))
    three, symbols, p = kneser_ney(texts)
    lang = langid._languages(model)[0]
    asked = [*three, (ord("t"), ord("h"), ord("z")), (ord("q"), ord("q"), ord("e")), (ord("q"), ord("t"), ord("h"))]
    keys = np.array([(u << 42) | (v << 21) | w for u, v, w in asked])
    assert np.allclose(np.exp(lang.log_prob(keys)), [p(*x) for x in asked], rtol=1e-12)
    letters = sorted({w for *_, w in three})
    for u, v in {(u, v) for u, v, _ in three} | {(1, 1), (9999, 9998)}:  # all characters and one unseen sum to one
        ks = np.array([(u << 42) | (v << 21) | w for w in [*letters, 70_000]])
        assert abs(np.exp(lang.log_prob(ks)).sum() - 1) < 1e-9
    assert symbols == len(letters) + 1


def test_pieces_count_like_the_whole(monkeypatch):
    text = "one two,  three! four 5 five six " * 40 + "the end of it"
    table = langid.letter_table()

    def counts():
        total, n = Counter(), 0
        for block in langid._blocks(pa.array([text, "short", text[7:]])):
            key, index, starts, _ = langid._trigrams(block, table)
            total.update(dict(zip(key.tolist(), np.bincount(index, minlength=len(key)).tolist())))
            n += len(block)
        return total, n
    whole, n = counts()
    assert n == 3
    for size in (1, 3, 50, 333):
        monkeypatch.setattr(langid, "PIECE", size)
        cut, n = counts()
        assert cut == whole and n > 3


def test_texts_in_no_known_language_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    learn = docs.withColumn("held_out", langid.held_out())
    model = langid.fit(learn.where("not held_out"))
    again = langid.fit(learn.where("not held_out").repartition(7))
    assert (model["heat"], model["threshold"], model["limits"]) == (again["heat"], again["threshold"], again["limits"])
    rng = np.random.default_rng(1)

    def letters(first, last, n):
        return "".join(rng.choice([*map(chr, range(first, last)), " "], n))
    strange = [letters(0x61, 0x7B, 400), letters(0x61, 0x7B, 60), letters(0x430, 0x450, 300), letters(0x4E00, 0x5E00, 200),
               "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto."]
    got = langid.identify(spark.createDataFrame([(t,) for t in strange], "text string"), model, []).collect()
    assert not any(r.accepted for r in got)
    kept = langid.identify(docs.where("lang is not null"), model, ["doc_id"]).agg(
        F.avg(F.col("accepted").cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert kept.a * kept.n >= kept.n - 1


def test_every_text_is_calibrated_on(spark, monkeypatch):
    monkeypatch.setattr(langid, "CALIBRATE_DOCS", 10, raising=False)  # no sample is taken any more
    rng = np.random.default_rng(4)
    words = {"en": ["the", "cat", "sat", "on", "mat", "house", "and", "with"], "de": ["der", "hund", "und", "katze", "haus", "mit", "auf"]}
    rows = [(" ".join(rng.choice(w, rng.integers(1, 30))), lang) for lang, w in words.items() for _ in range(300)]
    rows += rows[:50] + [("123", "en")]  # copies count once, texts without letters not at all
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    once = sorted(set(rows[:-1]))
    table = model["table"]
    truth = np.array([model["langs"].index(lang) for _, lang in once])
    h, n = langid._entropies(pa.array([t for t, _ in once]), model)
    out = []
    for (text, _), lang in zip(once, truth):  # each text alone, every trigram that only it has taken as unseen
        key, index, _, _ = langid._trigrams([(0, text, False)], table)
        times, p = np.bincount(index, minlength=len(key)), langid._languages(model)[lang]
        out.append(-(p.log_prob(key, times >= langid._look(p.k3, p.n3, key, 0.0)) * times).sum() / len(index))
    out = np.array(out)

    def loss(heat):
        return -np.log(np.maximum(langid._scores(h, n, heat)[1][np.arange(len(truth)), truth], 1e-9)).mean()
    assert model["heat"] == min(langid.HEATS, key=loss)
    best, p = langid._scores(h, n, model["heat"])
    sure = best == truth
    assert np.isclose(model["threshold"], (min(0.5, np.quantile(p.max(axis=1)[sure], langid.FALSE_REJECT)) + 0.5) / 2)
    for k in range(2):
        limits = []
        for band in range(3):
            own = (truth == k) & sure & (langid._band(n) == band)
            x = out[own if own.sum() >= langid.FEW else (truth == k) & sure]
            limits.append(2 * np.quantile(x, 1 - langid.FALSE_REJECT) - np.median(x))
        assert np.allclose(model["limits"][k], np.maximum.accumulate(limits[::-1])[::-1], rtol=1e-5)
