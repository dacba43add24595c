"""SentencePiece (BPE) encoding that keeps byte offsets, and decoding.

A text is first normalised: at every place the longest entry of the model's
compiled character map (a double-array trie over UTF-8 bytes) is replaced, and
for each normalised byte the place it came from is recorded.  Spaces become
U+2581, with one in front if the model asks for it.  The normalised text is cut
where no piece of the vocabulary can reach across (no piece holds the two
characters side by side), so each part is merged by itself: highest score
first, at equal scores from the left.  Characters without a piece become byte
pieces.  The lengths of the pieces and the recorded places project every piece
to the bytes of the original text that it stands for: ``starts``, ``ends``.
The first pieces of a character in byte pieces have an empty span, the last one
the whole character.

Defined cases: null text is empty text (only the begin and end ids, whose
spans are empty); texts of any length are read whole, in blocks of parts;
repeated rows give equal results; an empty table gives an empty result;
columns named like the results are replaced.  Unigram and word models, and
models with user-defined or unused pieces, are refused when loaded.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import islice, repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from ..session import share

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
#: ModelProto.SentencePiece.Type (fixed values of the model format)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLOCK = 200_000        # parts handled at a time
MAX_PARTS = 400_000    # encoded parts remembered by a task, in each of two generations (memory only)
SHORT = 48             # up to so many characters a part is merged by scanning, beyond with a heap


class CharMap:
    """The compiled character map: longest-prefix look-up in its double array."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.to = blob[4 + size:]
        self.first: dict[str, bool] = {}

    def _walk(self, data: bytes, at: int, end: int) -> tuple[int, int, bool]:
        """Place of the replacement and length of the longest entry, and
        whether all of ``data[at:end]`` is the beginning of some entry."""
        units, found, length = self.units, -1, 0
        node = self._child(units[0])
        for i in range(at, end):
            node ^= data[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[i]:
                return found, length, False
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found, length = units[node] & 0x7FFFFFFF, i + 1 - at
        return found, length, True

    @staticmethod
    def _child(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def starts(self, char: str) -> bool:
        """Whether an entry begins with this character."""
        got = self.first.get(char)
        if got is None:
            raw = char.encode()
            got = self.first[char] = self._walk(raw, 0, len(raw))[2]
        return got

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """What replaces the longest entry at ``at``, and its length."""
        found, length, _ = self._walk(data, at, len(data))
        return None if found < 0 else (self.to[found:self.to.index(b"\0", found)], length)


class Model:
    """A BPE model; see the module."""

    def __init__(self, values: dict):
        self.__dict__.update(values)

    @classmethod
    def parse(cls, proto: bytes) -> Model:
        """The model of a file's bytes; its attributes are plain values, which can be broadcast."""
        self = cls({})
        self._parse(proto)
        return self

    def _parse(self, proto: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto.FromString(proto)
        kinds = [p.type for p in m.pieces]
        if m.trainer_spec.model_type != pb.TrainerSpec.BPE or {USER_DEFINED, UNUSED} & {*kinds}:
            raise ValueError("only BPE models without user-defined or unused pieces")
        if m.trainer_spec.treat_whitespace_as_suffix or m.denormalizer_spec.precompiled_charsmap:
            raise ValueError("spaces as suffix and denormalisation are not supported")
        n = m.normalizer_spec
        self.prefix, self.squeeze, self.escape = n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces
        self.charsmap = bytes(n.precompiled_charsmap)
        self.pieces, self.kinds = [p.piece for p in m.pieces], kinds
        self.unk = kinds.index(UNKNOWN)
        self.bos, self.eos = (self.pieces.index(x) for x in (m.trainer_spec.bos_piece, m.trainer_spec.eos_piece))
        self.unk_surface = m.trainer_spec.unk_surface
        normal = [(p.score, p.piece) for p in m.pieces if p.type == NORMAL]
        # equal scores get equal ranks: the left one is merged first
        places = {s: i for i, s in enumerate(sorted({s for s, _ in normal}, reverse=True))}
        self.rank = {p: places[s] for s, p in normal}
        self.ids = {p: i for i, p in reversed([*enumerate(self.pieces)]) if kinds[i] != BYTE}
        self.bytes = [self.pieces.index(f"<0x{b:02X}>") for b in range(256)] if m.trainer_spec.byte_fallback else None
        self.inside = {p[i:i + 2] for _, p in normal for i in range(len(p) - 1)}
        self.limit = MAX_PARTS

    def prepare(self) -> Model:
        """What a task derives once: the cutting pattern, surfaces, memories."""
        if not hasattr(self, "cut"):
            space = SPACE if self.escape else " "
            joined = {c for pair in self.inside for c in pair}
            alone = {c for c in map(chr, range(128)) if c not in joined and c != space}
            # marks that no piece joins to anything but other marks and spaces: words are cut from them
            marks, left = {c for c in joined if unicodedata.category(c)[0] not in "LM" and c != space}, True
            while left:
                left = {c for x, y in self.inside for c, d in ((x, y), (y, x)) if c in marks and d not in marks and d != space}
                marks -= left
            lead, alone, marks = re.escape(space), _class(alone), _class(marks)
            kinds = [f"[^{lead}{marks}{alone}]+", f"[{marks}]+" if marks else ""]
            if any(pair[1] == space and pair[0] != space for pair in self.inside):  # pieces reach across spaces
                kinds = [f"[^{alone}]+" if alone else ".+"]
            else:
                kinds = [f"{lead}*{k}" for k in kinds if k] + [f"{lead}+"]
            self.cut = re.compile("|".join(kinds + [f"[{alone}]"] * bool(alone)), re.S)
            self.map = CharMap(self.charsmap) if self.charsmap else None
            self.surface = [b"" if k == CONTROL else self.unk_surface.encode() if k == UNKNOWN
                            else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
                            for p, k in zip(self.pieces, self.kinds)]
            self.control = np.array(self.kinds) == CONTROL
            self.width = np.array([len(p.encode()) for p in self.pieces])
            if self.bytes is not None:
                self.width[self.bytes] = 1
                self.byte = np.full(len(self.pieces), -1)
                self.byte[self.bytes] = np.arange(256)
            self.memory: list[dict] = [{}, {}]
        return self

    # -- normalisation ------------------------------------------------------
    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the
        byte of ``text`` that it comes from."""
        raw = text.encode()
        if self.map is None and not self.squeeze:
            space = SPACE if self.escape else " "
            out = (space if self.prefix and text else "") + (text.replace(" ", SPACE) if self.escape else text)
            # a character map could make the end differ; without one every byte is kept, a space as the marker's bytes
            data = np.frombuffer(raw, np.uint8)
            wide = len(space.encode())
            places = np.arange(len(raw) + 1, dtype=np.int32)
            if self.escape and (data == 32).any():
                width = np.ones(len(raw) + 1, np.int8)
                width[:-1][data == 32] = wide
                places = np.repeat(places, width)
            lead = np.zeros(wide if self.prefix and text else 0, np.int32)
            return out, np.concatenate([lead, places])
        return self._through_map(text, raw)

    def _chunks(self, text: str, raw: bytes) -> Iterator[tuple[bytes, int, int]]:
        """(normalised bytes, start, length) of each step of the longest-prefix
        walk; runs of characters that begin no entry and hold no space are one step."""
        stops = {c for c in set(text) if c == " " or (self.map is not None and self.map.starts(c))}
        if not stops:
            if raw:
                yield raw, 0, len(raw)
            return
        stop = re.compile(b"|".join(re.escape(c.encode()) for c in sorted(stops)))
        at = 0
        while at < len(raw):
            m = stop.search(raw, at)
            upto = m.start() if m else len(raw)
            if upto > at:
                yield raw[at:upto], at, upto - at
            if not m:
                return
            got = self.map.longest(raw, upto) if self.map is not None else None
            to, length = got or (m.group(), m.end() - upto)
            yield to, upto, length
            at = upto + length

    def _through_map(self, text: str, raw: bytes) -> tuple[str, np.ndarray]:
        space = (SPACE if self.escape else " ").encode()
        chunks = self._chunks(text, raw)
        out: list[bytes] = []
        places: list[np.ndarray] = []
        after_space, begun, end = self.squeeze, False, len(raw)

        def put(data: bytes, at: int, same: bool) -> None:
            out.append(data)
            places.append(np.arange(at, at + len(data), dtype=np.int32) if same else np.full(len(data), at, np.int32))

        for to, at, length in chunks:
            same = to == raw[at:at + length]
            if not begun:
                if self.squeeze and to == b" ":
                    continue  # leading spaces
                begun = True
                if self.prefix:
                    put(space, at, False)
            if after_space:
                to = to.lstrip(b" ")
            if not to:
                continue
            if b" " in to:
                put(to.replace(b" ", space), at, False)
            else:
                put(to, at, same)
            after_space = self.squeeze and to.endswith(b" ")
        if self.squeeze:
            while out and out[-1].endswith(space):  # trailing spaces
                out[-1] = out[-1][:-len(space)]
                cut = places[-1]
                end = int(cut[len(out[-1])])
                places[-1] = cut[:len(out[-1])]
                if not out[-1]:
                    out.pop(), places.pop()
        return b"".join(out).decode(), np.concatenate([*places, np.array([end], np.int32)])

    # -- merging -------------------------------------------------------------
    def _merge(self, part: str) -> list[str]:
        rank, none = self.rank, len(self.rank)
        parts = list(part)
        if len(parts) <= SHORT:
            get = rank.get
            ranks = list(map(get, map(add, parts, parts[1:]), repeat(none)))
            while ranks:
                best = min(ranks)
                if best == none:
                    break
                i = ranks.index(best)
                whole = parts[i] = parts[i] + parts[i + 1]
                del parts[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = get(parts[i - 1] + whole, none)
                if i < len(ranks):
                    ranks[i] = get(whole + parts[i + 1], none)
            return parts
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(len(parts) - 1)
                if (r := rank.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= len(parts) or len(parts[i]) + len(parts[j]) != len(whole) or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j] = whole, ""
            k = after[i] = after[j]
            if k < len(parts):
                before[k] = i
                if (r := rank.get(whole + parts[k])) is not None:
                    heapq.heappush(heap, (r, i, whole + parts[k]))
            h = before[i]
            if h >= 0 and (r := rank.get(parts[h] + whole)) is not None:
                heapq.heappush(heap, (r, h, parts[h] + whole))
        return [p for p in parts if p]

    def _encode_part(self, part: str) -> bytes:
        """Packed ids of one part; an unknown character, if there are no byte
        pieces, as its code point above the ids."""
        if len(part) <= SHORT:
            merged = self._merge(part)
        else:
            bounds = [0, *(i for i in range(1, len(part)) if part[i - 1:i + 1] not in self.inside), len(part)]
            merged = [p for a, b in zip(bounds, bounds[1:]) for p in self._merge(part[a:b])]
        ids = list(map(self.ids.get, merged))
        if None in ids:
            ids = [i for p, i in zip(merged, ids) for i in
                   ([i] if i is not None else [len(self.pieces) + ord(p)] if self.bytes is None
                    else [self.bytes[b] for b in p.encode()])]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _sizes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the length of each in normalised bytes."""
        if self.bytes is None:  # neighbouring unknown characters are one piece
            point = ids.astype(np.int64) - len(self.pieces)
            size = np.where(point < 0, self.width[np.minimum(ids, len(self.pieces) - 1)],
                            1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
            first = np.flatnonzero((point < 0) | np.concatenate([[True], point[:-1] < 0])[:len(point)])
            return np.where(point < 0, ids, self.unk)[first].astype("<u4"), np.add.reduceat(size, first) if len(first) else size
        size, byte = self.width[ids], self.byte[ids]
        for low, more in ((0xC0, 1), (0xE0, 2), (0xF0, 3)):  # the last piece of a character stands for all its bytes
            at = np.flatnonzero((byte >= low) & (byte < low + (0x100 - low) // 2))
            for k in range(more):
                size[at + k] = 0
            size[at + more] = more + 1
        return ids, size

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end ids, and the byte span of each in ``text``."""
        self.prepare()
        normal, places = self.normalise(text)
        ids = []
        if len(normal) <= 4 * BLOCK:
            blocks = iter([self.cut.findall(normal)])
        else:
            found = (m[0] for m in self.cut.finditer(normal))
            blocks = iter(lambda: list(islice(found, BLOCK)), [])
        for block in blocks:
            known, older = self.memory
            if len(known) > self.limit:
                known, older = self.memory[:] = {}, known
            for p in set(block).difference(known):
                known[p] = older.get(p) or self._encode_part(p)
            ids.append(b"".join(map(known.__getitem__, block)))
        out, size = self._sizes(np.frombuffer(b"".join(ids), "<u4"))
        upto = np.cumsum(size)
        starts, ends = places[upto - size], places[upto]
        last = places[-1:]
        return (np.concatenate([[self.bos], out, [self.eos]]).astype("<u4"),
                np.concatenate([[0], starts, last]).astype("<i4"), np.concatenate([[0], ends, last]).astype("<i4"))

    # -- decoding --------------------------------------------------------------
    def decode(self, ids: Iterable[int]) -> str:
        """The text of any sequence of ids."""
        self.prepare()
        ids = np.asarray(ids if isinstance(ids, np.ndarray) else list(ids), np.int64)
        inner = np.flatnonzero(self.control[ids[1:-1]]) + 1
        ids = ids.tolist()
        kinds, surface = self.kinds, self.surface
        lead, said = 0, []   # the marker in front of the text is not part of it
        for i in ids if self.prefix or self.squeeze else ():
            lead += 1
            if kinds[i] == CONTROL:
                continue
            if kinds[i] in (BYTE, UNKNOWN):
                said.append(surface[i])
                break
            marked = surface[i].startswith(b" ") and self.pieces[i].startswith(SPACE)
            said.append(surface[i][1:] if marked else surface[i])
            if said[-1] or (marked and not self.squeeze):
                break
        out, inner = [], [i for i in inner.tolist() if i >= lead]
        for a, b in zip([lead, *inner], [*inner, len(ids)]):  # byte pieces on both sides of a control id are no character
            out.append(b"".join([*said, *map(surface.__getitem__, ids[a:b])]))
            said = []
        try:
            return "".join([raw.decode() for raw in out])
        except UnicodeDecodeError:  # byte pieces that are no UTF-8: each stray byte is one U+FFFD
            return "".join([raw.decode("utf-8", "stray") for raw in out])


def _class(chars: set[str]) -> str:
    """The characters for use inside a regular expression's brackets."""
    return "".join(map(re.escape, sorted(chars)))


def _stray(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def _register() -> None:
    import codecs
    codecs.register_error("stray", _stray)


_register()


def load(spark, path: str, max_parts: int = MAX_PARTS):
    """The model, read once by the driver and broadcast (its size is fixed by
    the file).  ``max_parts`` bounds what a task remembers: memory against
    time, with no effect on results."""
    with open(path, "rb") as f:
        model = Model.parse(f.read())
    return share(spark, {**vars(model), "limit": max_parts})


def _model(values: dict) -> Model:
    """The task's model; kept with the broadcast value, so that later tasks of
    the same worker find what it remembers."""
    if "_model" not in values:
        values["_model"] = Model(dict(values)).prepare()
    return values["_model"]


def encode_texts(docs: DataFrame, model, arrays: bool = False) -> DataFrame:
    """``docs`` without ``text`` + ``n_tokens``, ``ids``, ``starts``, ``ends``
    (bytes of the text each id stands for) and ``decoded``, the text that the
    ids give.  ``ids``, ``starts`` and ``ends`` are packed little-endian 32-bit
    numbers, or arrays if asked for."""
    docs = docs.drop("n_tokens", "ids", "starts", "ends", "decoded")
    keep = [c for c in docs.columns if c != "text"]
    packed = [("ids", "<u4"), ("starts", "<i4"), ("ends", "<i4")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _register()
        pa.default_memory_pool().release_unused()
        m = _model(model.value)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                rows: dict[str, list] = {"n_tokens": [], "ids": [], "starts": [], "ends": [], "decoded": []}
                for text in part.column("text").to_pylist():
                    got = m.encode(text or "")
                    rows["n_tokens"].append(len(got[0]))
                    for (name, kind), x in zip(packed, got):
                        rows[name].append(x.astype(np.int32) if arrays else x.astype(kind).tobytes())
                    rows["decoded"].append(m.decode(got[0]))
                out = {c: part.column(c) for c in keep} | {
                    "n_tokens": pa.array(rows["n_tokens"], pa.int64()),
                    **{n: pa.array(rows[n], pa.list_(pa.int32()) if arrays else pa.binary()) for n, _ in packed},
                    "decoded": pa.array(rows["decoded"], pa.string())}
                yield pa.RecordBatch.from_pydict(out)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kind = "array<int>" if arrays else "binary"
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep]
                       + [f"n_tokens long, ids {kind}, starts {kind}, ends {kind}, decoded string"])
    return docs.mapInArrow(run, schema)
