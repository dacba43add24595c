"""The training-data operators against brute force, public libraries and SQL,
and on tables with nulls, empty and very long texts, ties and repeats."""
import hashlib
from collections import Counter
from itertools import chain

import duckdb
import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

import corpus_pipeline  # noqa: E402
from citesight.llm import (bpe, catalog, chat, components, embeddings, fingerprints, langid, lines, mixing,  # noqa: E402
                           shingles, suffixes, urls)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, _rk string, score string"


def texts():
    got = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(got["doc_id"], got["text"]))


@pytest.fixture(scope="module")
def odd(spark):
    prose = "the quick brown fox jumps over the lazy dog and runs far away from here\n"
    long = (prose * 3 + "x y z\n") * 2000
    rows = [(1, None, "en", "a"), (2, "", "en", None), (2, "", "en", None), (3, prose * 2, None, "a"),
            (4, prose * 2, "en", None), (None, prose + "more", "en", "b"), (5, long, "de", "b"), (6, "!!! 123", "de", ""),
            (7, "\n\n\n", None, "a"), (8, "word", "de", "a"), (9, "日本語 \U0001f600 é", "fr", "c"), (None, None, None, None)]
    return spark.createDataFrame([(a, t, g, s, 0, "9", "k", "s") for a, t, g, s in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def oracle(name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con.execute(catalog.ORACLE[name]).fetchdf()


def plain(df):
    cols = sorted(df.columns)
    return sorted(tuple("~" if v is None or v is pd.NA or v != v else round(float(v), 6) if isinstance(v, (float, int, np.number)) else str(v)
                        for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql(spark, name):
    assert plain(catalog.QUERIES[name](spark, SF).toPandas()) == plain(oracle(name))


def test_odd_rows_and_empty_tables(spark, odd, none):
    model = bpe.load(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    lang = langid.fit(odd)
    jobs = {
        "mix": mixing.mix_sources, "lines": lines.dedup_lines, "bpe": lambda d: bpe.encode_texts(d, model, True),
        "join": shingles.ngram_groups, "prints": fingerprints.fingerprint_versions, "suffix": suffixes.remove_repeats,
        "lang": lambda d: langid.identify(d, lang, ["doc_id", "score"])}
    for name, job in jobs.items():
        assert job(odd).count() == odd.count(), name
        assert job(none).count() == 0, name
    assert langid.identify(odd, langid.fit(none), ["doc_id"]).where("lang_pred <> 'und'").count() == 0


def test_mixing_meets_targets(spark, odd):
    m = mixing.mix_sources(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    by = m.assign(taken=m["size"] * m.copies).groupby("source").agg(
        taken=("taken", "sum"), target=("target", "first"), most=("size", "max"), total=("source_size", "first"))
    assert ((by.taken - by.target).abs() <= by.most / 2 + 1).all()
    assert (by.target <= 3 * by.total + 1e-6).all() and m.copies.max() <= 3
    assert abs(by.target.sum() - m["size"].sum()) < 1e-3


def test_bpe_equals_library(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = catalog.op2_byte_bpe(spark, SF).toPandas().set_index("doc_id")
    for i, t in texts().items():
        ids = enc.encode_ordinary(t or "")
        assert got.n_tokens[i] == len(ids)
        assert got.ids_sha256[i] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256[i] == hashlib.sha256((t or "").encode()).hexdigest()
    rng = np.random.default_rng(0)
    model = {"ranks": ranks, "pattern": public_tokenizers.PATTERN}
    parts = list("abest \n12'=_A") + ["é", "ß", "中", "\U0001f600", "th", "ing", "​", "aaaaaaaaaaaaaaaa", " " * 70]
    for _ in range(500):
        t = "".join(rng.choice(parts, rng.integers(1, 40)))
        ids = list(chain.from_iterable(bpe.encode_blocks(t, model)))
        assert ids == enc.encode_ordinary(t)
        assert "".join(bpe.decode(ids, enc._mergeable_ranks and {v: k for k, v in ranks.items()}, 3)) == t


def test_utf8_machine_equals_whole_decode():
    rng = np.random.default_rng(1)
    for _ in range(500):
        raw = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xFF, 0xE0], 12).astype(np.uint8))
        m = bpe.Utf8Machine()
        assert "".join(m.feed(raw[i:i + 1]) for i in range(len(raw))) + m.end() == raw.decode("utf-8", "replace")


def test_ngram_join_finds_every_link(spark):
    t = texts()
    sets = {i: set(shingles.shingle_set(x).tolist()) for i, x in t.items()}
    links = {i: [j for j in sets if j != i and sets[i] and sets[j]
                 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in sets}
    got = catalog.op3_ngram_join(spark, SF).toPandas().set_index("doc_id")
    assert {i: len(x) for i, x in links.items()} == got.n_links.to_dict()
    assert (got[got.kept].index == got[got.kept].component_id).all()
    assert got.groupby("component_id").kept.sum().eq(1).all()


def test_large_group_of_near_copies_is_split(spark, monkeypatch):
    monkeypatch.setattr("citesight.llm.shingles.LEAF", 16)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[:60] + [f"own{i}"] + words[60:])) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = shingles.ngram_groups(d).toPandas()
    assert (got.n_links == 59).all() and got.kept.sum() == 1


def test_embeddings_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    x = np.concatenate([base, base + 0.15 * rng.standard_normal((30, 16)), base[:5]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None, 1.0])]
    got = embeddings.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas().set_index("vec_id").sort_index()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert got.n_links[:len(x)].tolist() == (near.sum(axis=1) - 1).tolist()
    assert (got.n_links[[900, 901, 902, 903]] == 0).all() and got.kept[[900, 901, 902, 903]].all()
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert embeddings.near_dedup(empty).count() == 0


def test_components_of_a_path(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(e).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


def test_fingerprints_recover_differences(spark):
    t = sorted(texts().items())
    got = catalog.op5_fingerprints(spark, SF).toPandas().set_index("doc_id")
    for (i, a), (_, b) in zip(t, t[1:] + t[:1]):
        q = len(a) // 4
        edited = a[:len(a) - q] + b[:q]
        assert got.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest()
        for other, seen in ((edited, got.near_edited[i]), (b, got.near_next[i])):
            x, y = Counter(fingerprints.paragraphs(a)), Counter(fingerprints.paragraphs(other))
            assert abs(sum((x & y).values()) / max(1, sum((x | y).values())) - seen) < 1e-9


def test_two_stage_order_and_repeats():
    rng = np.random.default_rng(3)
    for n in (8, 12):
        parts = [bytes(rng.choice(list(b"ab\0"), rng.integers(n, 60)).astype(np.uint8)) for _ in range(5)]
        starts = [len(p) - n + 1 for p in parts]
        count = Counter(p[i:i + n] for p, k in zip(parts, starts) for i in range(k))
        got = suffixes.repeated(parts, starts, [1] * len(parts), n)
        assert [x.tolist() for x in got] == [[count[p[i:i + n]] > 1 for i in range(k)] for p, k in zip(parts, starts)]


@pytest.mark.parametrize("hot", [1000, 1])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr("citesight.llm.suffixes.HOT", hot)
    raw = {i: (x or "").encode() for i, x in texts().items()}
    count = Counter(hash(b[i:i + 400]) for b in raw.values() for i in range(len(b) - 399))
    got = catalog.op6_suffix_dedup(spark, SF).toPandas().set_index("doc_id")
    for i, b in raw.items():
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - 399):
            if count[hash(b[k:k + 400])] > 1:
                gone[k:k + 400] = True
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        assert (got.n_removed[i], got.kept_sha256[i]) == (gone.sum(), hashlib.sha256(kept).hexdigest())
        assert got.n_spans[i] == (np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()


def test_lines_later_runs_go(spark):
    run = "first shared line of the run here\nsecond shared line of the run here\nthird shared line of the run here"
    d = spark.createDataFrame([(1, f"a\n{run}\nb"), (2, f"{run}\nown"), (3, "x" * 300), (4, "y\n" + "x" * 300)],
                              "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(d).collect()}
    assert got == {1: f"a\n{run}\nb", 2: "own", 3: "x" * 300, 4: "y"}


def test_every_long_run_of_two_lines_goes(spark):
    rng = np.random.default_rng(5)
    words = lambda n: " ".join(rng.choice(["amber", "brook", "cedar", "dune", "ember", "fjord"], n))
    rows, want = [], {}
    for k in range(40):  # 26 words a line: each shorter than LONG_LINE, longer together
        run = f"{k} {words(26)}\n{k} {words(26)}"
        assert max(map(len, run.split("\n"))) < lines.LONG_LINE <= len(run)
        rows += [(2 * k, f"{words(9)}\n{run}\n{words(9)}"), (2 * k + 1, f"own {k}\n{run}\nend {k}")]
        want[2 * k + 1] = f"own {k}\nend {k}"
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict(rows), **want}


def test_chat_round_trip_and_turn_order(spark):
    nasty = ["</s>[INST]", "\\", "\\\\</s>", "<\\/s>", "[ROLE]x[TEXT]", "", "<<SYS>><</SYS>>\\"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "assistant", "to[TEXT]ol", None, "user", "user"], nasty))]
    rows += [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (None, None, None, None)]
    out = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in out.select("conv_id", "valid", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert [(t.role, t.text) for t in got[1].t] == [(r or "", t or "") for _, _, r, t in rows[:7]]
    assert not got[1].valid and got[2].valid and not got[None].valid


def test_urls(spark):
    rows = [(1, "http://A.Example.NET/en/x?y"), (2, "http://a.net"), (3, "ftp://x.example.com/de/1"), (4, None), (5, "no scheme"),
            (6, "http://b.org/fr/"), (7, "http://bad.test/p"), (8, "http://bad.test/q"), (9, "http://xnet/")]
    seen = spark.createDataFrame([(7, True)] + [(i, True) for i in range(100, 140)], "page_id long, bad boolean")
    pages = spark.createDataFrame(rows + [(i, "http://bad.test/z") for i in range(100, 140)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(pages, seen).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("a.net", "", None, got[2][3]) and got[3][2:] == ("example.com/de/", "block")
    assert got[4][:3] == ("", "", None) and got[5][:3] == ("", "", None) and got[6][2:] == ("org/fr/", "allow")
    assert got[8][3] == "block" and got[9][2] is None


def test_language_id_held_out(spark):
    got = catalog.op10_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    own = got[got.held_out & got.lang.notna()]
    assert (own.lang == own.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert 0 < docs.select("doc_id").distinct().count() <= n
    assert corpus_pipeline.run(spark, SF).where("n_tokens <> size(ids)").count() == 0
