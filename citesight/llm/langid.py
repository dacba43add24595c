"""Language ID with interpolated Kneser-Ney character trigram models.

Counts cover every learning document: tasks count packed trigrams per language
and the counts are summed by Spark.  The model -- one table of n-grams for all
languages, sorted hash arrays looked up by binary search -- is built from all
those counts and sent to the tasks; it grows with the distinct trigrams of the
input.  Prediction takes the language of the lowest cross-entropy per character
of the whole text; the score is a softmax that says how much better it fits than
the others.  A text is rejected if the score is too low, or if not even the best
language fits: its cross-entropy is beyond a limit for the language and the
length of the text.  Temperature, threshold and limits are calibrated on all
distinct learning texts, the limits as if a text's own trigrams had not been
learnt: tasks measure the texts, losses are summed and quantiles found by Spark.

Characters are lower-cased; every run of other than letters is one space.

Defined cases: null text, or text without a letter: ``und``, score 0; rows with
a null ``lang`` are never learnt from; without any learning document everything
is ``und``; ties take the first language by code point; one language scores 1;
texts of any length are read in pieces.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import share

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEATS = [2.0 ** e for e in np.arange(-4, 6.5, 0.5)]
FALSE_REJECT = 0.0001
BANDS = (16, 64)   # lengths from which texts are judged apart
FEW = 200          # fewer texts of a band are judged with all of their language
PIECE = 1 << 20
_BITS, _MASK = 21, (1 << 21) - 1
_TABLE = 0x32400
SPACE, START = 32, 1


def letter_table() -> np.ndarray:
    """Code point -> lower-cased letter, or a space for anything else."""
    out = np.full(_TABLE + 1, SPACE, dtype=np.uint32)
    for c in range(_TABLE):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _cuts(t: str) -> list[int]:
    """Where the pieces of a text start: each later one after two letters."""
    out, at = [0], PIECE
    while at < len(t):
        if t[at - 2:at].isalpha():
            out.append(at)
            at += PIECE
        else:
            at += 1
    return out


def _blocks(texts: pa.Array) -> Iterator[list[tuple[int, str, bool]]]:
    """Lists of (row, piece, whether it follows another), about ``PIECE``
    characters together; a longer text comes in several pieces, each later one
    with the two letters before it in front."""
    block, size = [], 0
    for at in range(0, len(texts), 256):
        for i, t in enumerate(texts.slice(at, 256).to_pylist(), at):
            if not t:
                continue
            cuts = _cuts(t)
            for a, z in zip(cuts, [*cuts[1:], len(t)]):
                block.append((i, t[max(0, a - 2):z], a > 0))
                size += z - a
                if size >= PIECE:
                    yield block
                    block, size = [], 0
    if block:
        yield block


def _trigrams(block: list[tuple[int, str, bool]], table: np.ndarray):
    """Of the block: distinct packed trigrams, each position's index among
    them, each piece's first position, and whether it has a letter.  The
    characters that a later piece repeats are context, not positions."""
    parts, starts, at = [], [], 0
    counted = []
    for _, piece, later in block:
        cp = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        cp = table[np.minimum(cp, _TABLE)]
        space = cp == SPACE
        keep = ~space
        keep[0] = True
        keep[1:] |= ~space[:-1]
        cp = cp[keep]
        head, cp = (cp[:2], cp[2:]) if later else (np.array([START, START], dtype=np.uint32), cp)
        parts += [head, cp]
        counted += [np.zeros(2, bool), np.ones(len(cp), bool)]
        starts.append(at)
        at += len(cp)
    s = np.concatenate(parts)
    letters, code = np.unique(s, return_inverse=True)
    n = len(letters)
    tri = (code[:-2] * n + code[1:-1]) * n + code[2:]
    tri = tri[np.concatenate(counted)[2:]]
    if n ** 3 <= 1 << 23:
        found = np.flatnonzero(np.bincount(tri, minlength=1))
        index = np.zeros(n ** 3, dtype=np.int32)
        index[found] = np.arange(len(found), dtype=np.int32)
        index = index[tri]
    else:
        found, index = np.unique(tri, return_inverse=True)
    u, v, w = letters[found // (n * n)], letters[found // n % n], letters[found % n]
    key = (u.astype(np.int64) << 2 * _BITS) | (v.astype(np.int64) << _BITS) | w
    return key, index, np.array(starts), w


def count_ngrams(docs: DataFrame, table) -> DataFrame:
    """``lang, key, n`` over all of ``docs`` (text, lang)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            texts, langs = b.column("text"), b.column("lang")
            for lang in langs.unique().to_pylist():
                own = texts.filter(pa.compute.equal(langs, lang))
                for block in _blocks(own):
                    key, index, _, _ = _trigrams(block, table.value)
                    n = np.bincount(index, minlength=len(key)).astype(np.int64)
                    if lang in total:
                        key, n = np.concatenate([total[lang][0], key]), np.concatenate([total[lang][1], n])
                        key, inv = np.unique(key, return_inverse=True)
                        n = np.bincount(inv, weights=n).astype(np.int64)
                    total[lang] = key, n
        for lang, (key, n) in total.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(key), pa.string()), "key": key, "n": n})

    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    return learn.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discount(n: np.ndarray) -> float:
    one, two = float((n == 1).sum()), float((n == 2).sum())
    return one / (one + 2 * two) if one and two else 0.5


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, inv = np.unique(keys, return_inverse=True)
    return k, np.bincount(inv, weights=values, minlength=len(k))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default) -> np.ndarray:
    """Values of the wanted keys in a sorted array, by binary search."""
    if not len(keys):
        return np.full((len(wanted), *values.shape[1:]), default, dtype=values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    out = values[at]
    out[keys[at] != wanted] = default
    return out


class _Language:
    """Interpolated Kneser-Ney estimates of one language."""

    def __init__(self, key: np.ndarray, n: np.ndarray, symbols: int):
        order = np.argsort(key)
        self.k3, self.n3 = key[order], n[order].astype(float)
        uv, vw, one = self.k3 >> _BITS, self.k3 & ((1 << 2 * _BITS) - 1), np.ones(len(key))
        self.d3 = _discount(n)
        self.uv, self.c3 = _sums(uv, self.n3)
        self.t3 = _sums(uv, one)[1]
        self.k2, self.n2 = _sums(vw, one)  # continuation counts
        self.d2 = _discount(self.n2)
        v, w = self.k2 >> _BITS, self.k2 & _MASK
        self.v, self.c2 = _sums(v, self.n2)
        self.t2 = _sums(v, np.ones(len(v)))[1]
        self.k1, self.n1 = _sums(w, np.ones(len(w)))
        self.d1, self.symbols = _discount(self.n1), symbols

    def log_prob(self, key: np.ndarray, unseen: np.ndarray | None = None) -> np.ndarray:
        """Of the last character after the first two; where ``unseen``, as if
        the trigram had not been counted."""
        total = self.n1.sum()
        p = np.maximum(_look(self.k1, self.n1, key & _MASK, 0.0) - self.d1, 0) / total
        p += self.d1 * len(self.n1) / total / self.symbols
        for d, keys, n, ctx, c, t, k in (
                (self.d2, self.k2, self.n2, self.v, self.c2, self.t2, key & ((1 << 2 * _BITS) - 1)),
                (self.d3, self.k3, self.n3, self.uv, self.c3, self.t3, key)):
            seen = _look(ctx, c, k >> _BITS, 0.0)
            own = np.maximum(_look(keys, n, k, 0.0) - d, 0)
            if unseen is not None and keys is self.k3:
                own = np.where(unseen, 0, own)
            p = np.where(seen > 0, (own + d * _look(ctx, t, k >> _BITS, 0.0) * p) / np.maximum(seen, 1), p)
        return np.log(p)


def fit(docs: DataFrame) -> dict:
    """The model of ``docs`` (text, lang), with calibration; see the module."""
    spark = docs.sparkSession
    table = letter_table()
    from ..session import materialize
    counts = materialize(count_ngrams(docs, share(spark, table)))
    got = counts.toPandas()
    langs = sorted(got.lang.unique().tolist())
    symbols = max(1, len(np.unique(got.key.to_numpy() & _MASK)) + 1)
    parts = [_Language(g.key.to_numpy(), g.n.to_numpy(), symbols) for _, g in got.groupby("lang", sort=True)]
    keys = np.unique(got.key.to_numpy()) if len(got) else np.zeros(0, np.int64)
    known = np.stack([p.log_prob(keys) for p in parts], axis=1).astype(np.float32) if parts else np.zeros((0, 0), np.float32)
    model = {"table": table, "langs": langs, "keys": keys, "logp": known, "parts": [vars(p) for p in parts],
             "heat": 1.0, "threshold": 0.0, "limits": [[float("inf")] * (len(BANDS) + 1)] * len(langs)}
    return _calibrate(docs, model) if langs else model


def _entropies(texts: pa.Array, model: dict, langs: np.ndarray | None = None):
    """Cross-entropy per character of each text in each language, and lengths
    (0: no letter).  With ``langs``, the labels' places, also the cross-entropy
    in the language of the label as if the trigrams that only this text has had
    not been counted."""
    sums, length = np.zeros((len(texts), len(model["langs"]))), np.zeros(len(texts))
    letter = np.zeros(len(texts), dtype=bool)
    left_out = np.zeros(len(texts))
    for block in _blocks(texts):
        key, index, starts, w = _trigrams(block, model["table"])
        if len(model["langs"]):
            lp = _look(model["keys"], model["logp"], key, np.nan)
            new = np.isnan(lp[:, 0])
            if new.any():
                lp[new] = np.stack([p.log_prob(key[new]) for p in _languages(model)], axis=1)
        rows = np.array([i for i, _, _ in block])
        sizes = np.diff(np.append(starts, len(index)))
        for j in range(len(model["langs"])):
            np.add.at(sums[:, j], rows, np.add.reduceat(lp[:, j][index].astype(np.float64), starts))
        np.add.at(length, rows, sizes)
        np.logical_or.at(letter, rows, np.logical_or.reduceat((w != SPACE)[index], starts))
        if langs is not None:
            _leave_out(left_out, langs, model, key, index, np.repeat(rows, sizes), lp)
    entropies, letters = -sums / np.maximum(length, 1)[:, None], np.where(letter, length, 0)
    if langs is None:
        return entropies, letters
    own = entropies[np.arange(len(texts)), langs]
    return entropies, letters, own - left_out / np.maximum(length, 1)


def _languages(model: dict) -> list[_Language]:
    if "built" not in model:
        model["built"] = []
        for p in model["parts"]:
            lang = object.__new__(_Language)
            lang.__dict__.update(p)
            model["built"].append(lang)
    return model["built"]


def _leave_out(change: np.ndarray, langs: np.ndarray, model: dict, key: np.ndarray, index: np.ndarray,
               rows: np.ndarray, lp: np.ndarray) -> None:
    """Adds to each row's ``change`` what the log-probability of its text in the
    language of its label gains without the trigrams that only this text has."""
    pair, n = np.unique(rows * len(key) + index, return_counts=True)
    row, at = pair // len(key), pair % len(key)
    for j in np.unique(langs[row]):
        p = _languages(model)[j]
        mine = langs[row] == j
        r, k, times = row[mine], at[mine], n[mine]
        only = times >= _look(p.k3, p.n3, key, 0.0)[k]
        r, k, times = r[only], k[only], times[only]
        distinct, back = np.unique(k, return_inverse=True)
        without = p.log_prob(key[distinct], np.ones(len(distinct), bool))[back]
        np.add.at(change, r, (without - lp[k, j]) * times)


def _band(length: np.ndarray) -> np.ndarray:
    return np.searchsorted(BANDS, length, side="right")


def _limits(langs: int, count: dict, of: dict) -> list[list[float]]:
    """For each language and band of lengths the cross-entropy beyond which a
    text is in no language known: as far again from the middle as the
    ``FALSE_REJECT`` quantile.  ``of``: middle and quantile by (language, band)
    and by (language, None).  A band with few texts takes all of its language;
    without any, every text is accepted."""
    out = []
    for k in range(langs):
        limits = []
        for band in range(len(BANDS) + 1):
            middle, far = of[k, band if count.get((k, band), 0) >= FEW else None]
            limits.append(2 * far - middle if far is not None else float("inf"))
        # a short text is not judged more strictly than a longer one
        out.append(np.maximum.accumulate(limits[::-1])[::-1].tolist())
    return out


def _scores(h: np.ndarray, length: np.ndarray, heat: float) -> tuple[np.ndarray, np.ndarray]:
    z = -h * np.sqrt(length)[:, None] * heat
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return h.argmin(axis=1), z / z.sum(axis=1, keepdims=True)


def _calibrate(docs: DataFrame, model: dict) -> dict:
    from ..operators.quantiles import exact_quantiles
    from ..session import materialize
    langs = model["langs"]
    b = share(docs.sparkSession, model)
    place = {lang: i for i, lang in enumerate(langs)}

    def run(batches):
        for x in batches:
            truth = np.array([place[lang] for lang in x.column("lang").to_pylist()], dtype=np.int64)
            h, n, left_out = _entropies(x.column("text"), b.value, truth)
            yield pa.RecordBatch.from_pydict({
                "digest": x.column("digest"), "truth": truth, "h": pa.array(list(h), pa.list_(pa.float64())), "n": n,
                "left_out": left_out})

    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.md5("text").alias("digest"))
    # each text once, whatever is repeated how often
    texts = materialize(learn.mapInArrow(run, "digest string, truth long, h array<double>, n double, left_out double")
                        .where("n > 0").dropDuplicates(["digest", "truth"]).drop("digest"))

    def measures(x):
        h = np.array(x.column("h").to_pylist()).reshape(x.num_rows, len(langs))
        return h, x.column("n").to_numpy(), x.column("truth").to_numpy()

    def losses(batches):
        for x in batches:
            h, n, truth = measures(x)
            # in units of 2 ** -53 and by halves, so that sums are exact in any order
            own = [np.maximum(_scores(h, n, heat)[1][np.arange(len(truth)), truth], 1e-9) for heat in HEATS]
            units = [np.rint(-np.log(p) * 2.0 ** 53).astype(np.int64) for p in own]
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(len(HEATS)), pa.int32()),
                "high": [int((u >> 32).sum()) for u in units], "low": [int((u & 0xFFFFFFFF).sum()) for u in units]})

    sums = texts.mapInArrow(losses, "i int, high long, low long").groupBy("i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    if not sums:
        return model
    heat = float(HEATS[min(sums, key=lambda r: ((r.high << 32) + r.low, r.i)).i])

    def judged(batches):
        for x in batches:
            h, n, truth = measures(x)
            best, p = _scores(h, n, heat)
            sure = best == truth
            yield pa.RecordBatch.from_pydict({
                "lang": truth[sure], "band": _band(n[sure]).astype(np.int64), "p": p.max(axis=1)[sure],
                "left_out": x.column("left_out").to_numpy()[sure]})

    right = materialize(texts.mapInArrow(judged, "lang long, band long, p double, left_out double"))
    count = {(r.lang, r.band): r["count"] for r in right.groupBy("lang", "band").count().collect()}
    if not count:
        return model | {"heat": heat}
    groups = [(k, band) for k in range(len(langs)) for band in (*range(len(BANDS) + 1), None)
              if band is None or count.get((k, band), 0) >= FEW]
    cols = {f"g{i}": F.when((F.col("lang") == k) & (F.lit(True) if band is None else F.col("band") == band), F.col("left_out"))
            for i, (k, band) in enumerate(groups)}
    got = exact_quantiles(right.select("p", *[c.alias(name) for name, c in cols.items()]),
                          {"p": [FALSE_REJECT]} | {name: [0.5, 1 - FALSE_REJECT] for name in cols})
    # halfway from chance to what nearly all reach
    threshold = (min(0.5, got["p"][0]) + 1 / len(langs)) / 2
    return model | {"heat": heat, "threshold": min(threshold, 0.5),
                    "limits": _limits(len(langs), count, {g: tuple(got[f"g{i}"]) for i, g in enumerate(groups)})}


def identify(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` + ``lang_pred``, ``score``, ``accepted``."""
    b = share(docs.sparkSession, {k: v for k, v in model.items() if k != "built"})
    keep = [c for c in keep if c not in ("lang_pred", "score", "accepted")]  # replaced
    docs = docs.select(*[F.col(c) for c in dict.fromkeys([*keep, "text"])])
    names = [c for c in docs.columns if c in keep]

    def run(batches):
        for x in batches:
            m = b.value
            n_rows = x.num_rows
            if m["langs"] and n_rows:
                h, n = _entropies(x.column("text"), m)
                best, p = _scores(h, n, m["heat"])
                known = n > 0
                pred = np.where(known, np.array(m["langs"], dtype=object)[best], "und")
                score = np.where(known, p.max(axis=1), 0.0)
                fits = h.min(axis=1) <= np.array(m["limits"])[best, _band(n)]
            else:
                pred, score, fits = np.full(n_rows, "und", dtype=object), np.zeros(n_rows), np.zeros(n_rows, bool)
            out = {c: x.column(c) for c in names}
            out |= {"lang_pred": pa.array(list(pred), pa.string()), "score": pa.array(score, pa.float64()),
                    "accepted": pa.array((pred != "und") & (score >= m["threshold"]) & fits)}
            yield pa.RecordBatch.from_pydict(out)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["lang_pred string", "score double", "accepted boolean"])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the decimal doc_id mod 3 is 1 (a null doc_id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
