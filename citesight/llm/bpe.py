"""Byte-level BPE: encoding with a lazily determinised transducer, streaming
decoding with an incremental UTF-8 state machine.

A token sequence is what the merges give exactly if each adjacent pair is what
they give for the pair alone.  Read byte by byte, every prefix of a piece thus
has one last token, and the open alternatives are few: (token before, place in
the vocabulary's trie) for each start from which a token can still grow.  Such
a set of alternatives is a state of the deterministic machine; a transition
puts out the last token of the prefix read.  When one alternative is left, the
tokens up to there are certain and are emitted, so the lookahead is bounded by
the longest token that can still grow.  States and transitions are made when
first met, and kept up to a bound.

Each match of the pattern is encoded separately, as in the public tokenizer
libraries; no special tokens.

Defined cases: null text is empty text, with no tokens; texts of any length are
read match by match in blocks; repeated rows give equal results; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import share

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 100_000          # matches handled at a time
MAX_PIECES = 250_000     # encoded matches remembered by a task, in each of two generations
SEEN = 1 << 21           # slots that tell whether a match was met before; only those are remembered
MAX_STATES = 200_000     # states remembered by a task
LOOKAHEAD = 64           # bytes held back before certain tokens are looked for


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Encodes single matches; see the module."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.vocab = {i: b for b, i in ranks.items()}
        self.size = {i: len(b) for b, i in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for b, i in ranks.items():
            node = 0
            for x in b:
                nxt = self.children[node].get(x)
                if nxt is None:
                    nxt = self.children[node][x] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = i
        # a token that the merges never give by themselves can only be a whole match
        self.reachable: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._forget()

    def _forget(self) -> None:
        start = (0,)  # an alternative is one number: (token before + 1) << 32 | place in the trie
        self.ids, self.states, self.next = {start: 0}, [start], {}

    def merge(self, piece: bytes) -> list[int]:
        """The merges' own result, by ranks."""
        return [self.ranks[p] for p in self._merged(piece, 1)]

    def _before_last(self, piece: bytes) -> list[bytes]:
        return self._merged(piece, 2)

    def _merged(self, piece: bytes, down_to: int) -> list[bytes]:
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > down_to:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _split(self, t: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of ``t`` joined; None for a byte."""
        if t not in self.halves:
            b = self.vocab[t]
            parts = [b] if len(b) == 1 else self._before_last(b)
            self.halves[t] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[t]

    def _follows(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` standing side by side."""
        ok = self.reachable.get(b)
        if ok is None:
            ok = self.reachable[b] = self.merge(self.vocab[b]) == [b]
        if not ok or a < 0:
            return ok
        known = self.pairs.get(a << 32 | b)
        if known is None:
            if len(self.pairs) > 4 * self.max_states:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        """No merge across the border may come before the merges that hide it.
        The history is walked backwards, undoing the later merge each time."""
        vocab, ranks, left, right = self.vocab, self.ranks, a, b
        hidden = 1 << 60  # a border merge of this rank or above comes too late; at equal rank the left one is first
        while True:
            across = ranks.get(vocab[left] + vocab[right])
            if across is not None and across < hidden:
                return False
            sl, sr = self._split(left), self._split(right)
            if sl is None and sr is None:
                return True
            if sr is None or (sl is not None and left > right):
                hidden, left = left, sl[1]
            else:
                hidden, right = right + 1, sr[0]

    def _step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The next state, and the last token of the text up to here."""
        out, last = [], -1
        for alternative in state:
            prev, nxt = (alternative >> 32) - 1, self.children[alternative & 0xFFFFFFFF].get(byte)
            if nxt is None:
                continue
            t = self.token[nxt]
            if t >= 0 and last < 0 and self._follows(prev, t):
                last = t
            if self.children[nxt]:
                out.append(prev + 1 << 32 | nxt)
        out.append(last + 1 << 32)
        return tuple(out), last

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.states) > self.max_states:
            self._forget()
        at, nxt = 0, self.next
        last: list[int] = []     # last token of each prefix that is not emitted
        if len(piece) <= LOOKAHEAD:
            for byte in piece:
                at, token = nxt.get(at << 8 | byte) or self._move(at, byte)
                last.append(token)
            return tuple(self._back(last))
        out: list[int] = []      # tokens that every alternative agrees on
        for byte in piece:
            at, token = nxt.get(at << 8 | byte) or self._move(at, byte)
            last.append(token)
            if len(last) >= LOOKAHEAD and len(self.states[at]) == 1:
                out += self._back(last)
                last = []
        return (*out, *self._back(last))

    def _move(self, at: int, byte: int) -> tuple[int, int]:
        """Makes a transition that is met for the first time."""
        state, token = self._step(self.states[at], byte)
        to = self.ids.get(state)
        if to is None:
            to = self.ids[state] = len(self.states)
            self.states.append(state)
        got = self.next[at << 8 | byte] = to, token
        return got

    def _back(self, last: list[int]) -> list[int]:
        out, i, size = [], len(last), self.size
        while i:
            out.append(last[i - 1])
            i -= size[last[i - 1]]
        return out[::-1]


class Utf8Machine:
    """Decodes bytes that arrive in pieces: a state machine of the number of
    continuation bytes still due and the range allowed for the next one;
    anything invalid becomes U+FFFD as in a whole decode."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _open(tail: bytes) -> int:
        """Length of the incomplete but still valid character at the end."""
        for back in range(1, min(3, len(tail)) + 1):
            lead = tail[-back]
            if lead & 0xC0 == 0x80:
                continue
            due = 1 if 0xC2 <= lead <= 0xDF else 2 if 0xE0 <= lead <= 0xEF else 3 if 0xF0 <= lead <= 0xF4 else 0
            if back > due:
                return 0
            if back > 1:
                lo, hi = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
                if not lo <= tail[-back + 1] <= hi:
                    return 0
            return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        n = len(data) - self._open(data[-3:])
        self.held = data[n:]
        return data[:n].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


def decode(ids: Iterable[int], vocab: dict[int, bytes], block: int = BLOCK) -> Iterator[str]:
    """The text of ``ids``, in pieces."""
    machine, ids = Utf8Machine(), iter(ids)
    while got := list(islice(ids, block)):
        yield machine.feed(b"".join(map(vocab.__getitem__, got)))
    yield machine.end()


def _encoder(model: dict) -> tuple:
    """The task's machine; it is kept with the broadcast value, so that later
    tasks of the same worker find its states."""
    if "machine" not in model:
        import regex
        machine = Transducer(model["ranks"], model.get("states", MAX_STATES))
        model["machine"] = machine, regex.compile(model["pattern"]), [{}, {}, bytearray(SEEN)], {i: str(i) for i in machine.vocab}
    return model["machine"]


def encode_blocks(text: str, model: dict) -> Iterator[list[int]]:
    """Token ids of a text, a block of matches at a time."""
    machine, pattern, remembered, _ = _encoder(model)
    if len(text) <= 4 * BLOCK:
        blocks = iter([pattern.findall(text)])
    else:
        found = (m[0] for m in pattern.finditer(text))
        blocks = iter(lambda: list(islice(found, BLOCK)), [])
    for block in blocks:
        known, older, seen = remembered
        if len(known) > model.get("pieces", MAX_PIECES):
            known, older, seen = remembered[:] = {}, known, bytearray(SEEN)
        once = []  # most matches that are met once are never met again
        for p in set(block).difference(known):
            got = older.get(p)
            if got is None:
                got = machine.encode(p.encode("utf-8"))
                slot = hash(p) % SEEN
                if not seen[slot]:
                    seen[slot] = 1
                    once.append(p)
            known[p] = got
        ids = list(chain.from_iterable(map(known.__getitem__, block)))
        for p in once:
            del known[p]
        yield ids


def load(spark, path: str, pattern: str, max_pieces: int = MAX_PIECES, max_states: int = MAX_STATES):
    """The vocabulary, read once by the driver and broadcast (its size is
    fixed by the file).  ``max_pieces`` and ``max_states`` bound what a task
    remembers: memory against time, with no effect on results."""
    return share(spark, {"ranks": read_ranks(path), "pattern": pattern, "pieces": max_pieces, "states": max_states})


def encode_texts(docs: DataFrame, model, with_ids: bool = False) -> DataFrame:
    """``docs`` without ``text`` + ``n_tokens``, ``ids_sha256`` (decimal ids
    joined by a space) and ``decoded_sha256`` (the ids decoded again), and the
    ids themselves if asked for."""
    added = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    docs = docs.drop(*added)
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what earlier stages left in this worker
        m = model.value
        machine, _, _, decimal = _encoder(m)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                n_tokens, ids_sha, text_sha, all_ids = [], [], [], []
                for text in part.column("text").to_pylist():
                    n, said, back, utf8, ids = 0, hashlib.sha256(), hashlib.sha256(), Utf8Machine(), []
                    for block in encode_blocks(text or "", m):
                        if not block:
                            continue
                        said.update(((" " if n else "") + " ".join(map(decimal.__getitem__, block))).encode())
                        back.update(utf8.feed(b"".join(map(machine.vocab.__getitem__, block))).encode())
                        n += len(block)
                        if with_ids:
                            ids += block
                    back.update(utf8.end().encode())
                    n_tokens.append(n)
                    ids_sha.append(said.hexdigest())
                    text_sha.append(back.hexdigest())
                    all_ids.append(ids)
                out = {c: part.column(c) for c in keep} | {
                    "n_tokens": pa.array(n_tokens, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
                    "decoded_sha256": pa.array(text_sha, pa.string())}
                if with_ids:
                    out["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["n_tokens long, ids_sha256 string, decoded_sha256 string"]
                       + ["ids array<int>"] * with_ids)
    return docs.mapInArrow(run, schema)
