"""SentencePiece encoding against the public library, with its own model, and
with small models that have a compiled character map."""
import hashlib
import struct

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from sentencepiece import sentencepiece_model_pb2 as pb  # noqa: E402

from citesight.llm import catalog, pieces  # noqa: E402

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return pieces.Model.parse(f.read())


def double_array(entries: dict[bytes, int]) -> bytes:
    """A double-array trie of (key -> value), built by first fit."""
    tree: dict = {}
    for k, v in entries.items():
        node = tree
        for b in k:
            node = node.setdefault(b, {})
        node[-1] = v
    units, used = {0: 0}, {0}
    todo = [(0, tree)]
    while todo:
        at, node = todo.pop()
        labels = [0 if b == -1 else b for b in node]
        base = next(x for x in range(1, 1 << 20) if x != at and not {x ^ b for b in labels} & used)
        off = base ^ at
        assert off < 1 << 21
        units[at] |= off << 10 | (256 if -1 in node else 0)
        for b, child in node.items():
            place = base ^ (0 if b == -1 else b)
            used.add(place)
            if b == -1:
                units[place] = child | 1 << 31
            else:
                units[place] = b
                todo.append((place, child))
    n = (max(units) // 256 + 1) * 256
    return struct.pack(f"<{n}I", *(units.get(i, 0) for i in range(n)))


def small_model(rules: dict[str, str], byte_fallback: bool, squeeze: bool, prefix: bool = True) -> bytes:
    texts, at = b"", {}
    for k, v in rules.items():
        at[k.encode()] = len(texts)
        texts += v.encode() + b"\0"
    m = pb.ModelProto()
    m.trainer_spec.model_type = pb.TrainerSpec.BPE
    m.trainer_spec.byte_fallback = byte_fallback
    m.normalizer_spec.name = "own"
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = prefix, squeeze
    if rules:
        trie = double_array(at)
        m.normalizer_spec.precompiled_charsmap = struct.pack("<I", len(trie)) + trie + texts

    def add(piece, kind, score=0.0):
        m.pieces.add(piece=piece, type=kind, score=score)
    add("<unk>", pieces.UNKNOWN), add("<s>", pieces.CONTROL), add("</s>", pieces.CONTROL)
    if byte_fallback:
        for b in range(256):
            add(f"<0x{b:02X}>", pieces.BYTE)
    for i, p in enumerate(["ab", "▁a", "▁ab", "aa", "aaaa", "fi", "bc", "b▁", "▁▁", "a", "b", "c", "f", "i", "▁", "x", "é"]):
        add(p, pieces.NORMAL, -float(i // 2))  # equal scores in pairs
    return m.SerializeToString()


def spans(lib, text):
    got = lib.encode(text, return_type="proto")
    return [(p.id, p.surface) for p in got.pieces]


def test_query_equals_library(spark, library):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    got = catalog.op13_sentence_pieces(spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(t["doc_id"])
    for i, text in zip(t["doc_id"], t["text"]):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert got.n_tokens[i] == len(ids)
        assert got.ids_sha256[i] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got.decoded_sha256[i] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_strings_spans_and_decoding_equal_library(library, model):
    rng = np.random.default_rng(0)
    parts = list("abest \n\t12'=_A,.▁\0") + ["é", "中", "\U0001f600", "the ", " ing", "  ", "<s>", "<0x41>", "a" * 70, " " * 40, "ﬁ", "\r\n"]
    for _ in range(1500):
        text = "".join(rng.choice(parts, rng.integers(0, 30)))
        ids, starts, ends = model.encode(text)
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert model.decode(ids) == library.decode(ids.tolist())
        raw = text.encode()
        own = [(int(i), raw[a:b].decode()) for i, a, b in zip(ids[1:-1], starts[1:-1], ends[1:-1])]
        assert own == spans(library, text)


def test_any_ids_decode_as_in_library(library, model):
    rng = np.random.default_rng(1)
    low = np.arange(0, 300)
    for _ in range(2000):
        ids = [int(i) for i in rng.choice(low if rng.random() < 0.5 else 32000, rng.integers(0, 12))]
        assert model.decode(ids) == library.decode(ids), ids


RULES = {"ﬁ": "fi", "A": "a", "é": "é", "　": " ", "\t": " ", "\x01": "", "ab c": "x", "…": "...", "xx": "  "}


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("rules", [RULES, {}])
def test_character_map(byte_fallback, squeeze, prefix, rules):
    proto = small_model(rules, byte_fallback, squeeze, prefix)
    lib, own = sentencepiece.SentencePieceProcessor(model_proto=proto), pieces.Model.parse(proto)
    rng = np.random.default_rng(2)
    parts = ["a", "b", "c", " ", "  ", "ﬁ", "A", "é", "é", "　", "\t", "\x01", "ab c", "…", "中", "aaaa", "x", "xx", "ab "]
    for _ in range(1500):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        ids, starts, ends = own.encode(text)
        assert ids[1:-1].tolist() == lib.encode(text), text
        raw = text.encode()
        got = [(int(i), raw[a:b].decode()) for i, a, b in zip(ids[1:-1], starts[1:-1], ends[1:-1])]
        assert got == spans(lib, text), text
        assert own.decode(ids) == lib.decode(ids.tolist()), text


def test_short_and_long_parts_merge_alike(model, monkeypatch):
    rng = np.random.default_rng(3)
    for _ in range(300):
        part = "▁" + "".join(rng.choice(list("abcdeinrst"), rng.integers(1, 45)))
        scanned = model._merge(part)
        monkeypatch.setattr(pieces, "SHORT", 0)
        assert model._merge(part) == scanned
        monkeypatch.undo()


def test_very_long_texts(library, model):
    for text in ("a" * 300_000, "word " * 200_000, "中" * 100_000):
        assert model.encode(text)[0].tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_odd_rows(spark):
    rows = [(1, None, "n"), (2, "", "m"), (2, "", "m"), (None, "two words", None), (3, "two words", "k")]
    schema = "doc_id long, text string, ids string"
    model = pieces.load(spark, PATH, max_parts=1)
    got = pieces.encode_texts(spark.createDataFrame(rows, schema), model, arrays=True).collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in got[:3]] == [(1, [1, 2], ""), (2, [1, 2], ""), (2, [1, 2], "")]
    assert got[3].ids == got[4].ids and got[3].starts[1:-1] == [0, 3] and got[3].ends[1:] == [3, 9, 9]
    assert pieces.encode_texts(spark.createDataFrame([], schema), model).count() == 0
