"""Byte-level BPE encoding by a lazily determinised finite-state transducer, and streaming decoding.

**Encoding.** In the BPE encoding of a byte string every adjacent pair of tokens is *compatible*: merging the
bytes of the two alone gives back just these two tokens. Conversely, a sequence of tokens whose adjacent pairs
are all compatible is the encoding of its bytes, and every prefix of the input has exactly one such sequence.
So the last token of each prefix's encoding is a function of the last tokens of the shorter prefixes, and
reading one more byte means: among the tokens that end here, find the one compatible with the last token
before it. A state of the transducer is what the future can depend on: the chain of last tokens of the
prefixes at which a token may be under way. States and transitions are made when first met and then
remembered (lazy determinisation). As soon as all prefixes a future token may follow share an ancestor, the
tokens up to it are emitted and leave the state, so the lookahead is bounded by the longest token.

Texts are cut by the pattern first; each match goes through the transducer on its own (whole matches that are
tokens are emitted at once, as the rank files define) and is remembered within a bound.

**Decoding.** Tokens are bytes, and a character may be split between tokens. A small state machine over lead
and continuation bytes holds back an unfinished character until it is complete.

Null and empty texts have no tokens, and the digests of the empty string. A text of any length is encoded whole; a match as
long as the text is worked through ``STRIDE`` bytes at a time. Repeated rows give repeated rows, an empty table an empty one;
other columns are ignored, whatever their names, and rows without an id keep their null id.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wordloom.llm.base import map_slices, register, table

#: Matches whose ids a worker remembers (two generations of half as many: a new word returns soon or never), and states.
CACHE_PIECES = 200_000
MAX_STATES = 150_000
#: Ids decoded at a time.
DECODE_IDS = 4096
#: Bytes worked through at a time where the states are not remembered.
STRIDE = 32
NEVER = 1 << 62
#: Stands for the last emitted token where no token can follow it any more: what lies before then makes no difference.
PAST = -2
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Ranks:
    """A merge table: byte string -> rank (= id)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        #: Proper beginnings of tokens: where a token may still be under way.
        self.begun = {b[:k] for b in ranks for k in range(1, len(b))}
        self.bytes = {i: b for b, i in ranks.items()}
        #: byte string -> (id or -1, may a token still be under way?)
        self.nodes = dict.fromkeys(self.begun, (-1, True)) | {b: (i, b in self.begun) for b, i in ranks.items()}
        #: left << 32 | right -> compatible?
        self.pairs: dict[int, bool] = {}
        self._splits: dict[int, tuple[int, int] | None] = {}

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the merge that makes ``token``; None for a byte and for a token that merging its
        bytes does not give (such tokens match only as whole pieces)."""
        if token not in self._splits:
            data, parts = self.bytes[token], [self.bytes[token][i:i + 1] for i in range(len(self.bytes[token]))]
            while len(parts) > 2:
                best, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
                if best == NEVER:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            whole = len(parts) == 2 and parts[0] + parts[1] == data
            self._splits[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if whole else None
        return self._splits[token]

    def is_reachable(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self.split(token) is not None

    def compatible(self, left: int, right: int) -> bool:
        """Does merging the bytes of both alone give back these two? Walks back in time from both: whichever
        was made last is split, and the two parts next to the boundary must never have been mergeable before
        they were used up. Of equal ranks the leftmost merge comes first."""
        if left < 0:
            return self.is_reachable(right)
        if len(self.pairs) > 300_000:
            self.pairs.clear()
        x, y, x_until, y_until, ok = left, right, NEVER, NEVER, self.is_reachable(right)
        while ok:
            joint = self.ranks.get(self.bytes[x] + self.bytes[y], NEVER)
            if joint < x_until and joint <= y_until and joint != NEVER:
                ok = False
                break
            x_made = x if len(self.bytes[x]) > 1 else -1
            y_made = y if len(self.bytes[y]) > 1 else -1
            if x_made == y_made == -1:
                break
            if x_made > y_made:
                x, x_until = self.split(x)[1], x
            else:
                y, y_until = self.split(y)[0], y
        self.pairs[left << 32 | right] = ok
        return ok


class Transducer:
    """A state is (tail, lasts, starts, live): the bytes read since the last emitted token; for each prefix of
    the tail the last token of its encoding and where that token starts (the first entry is the emitted past);
    and the prefixes after which the bytes so far begin some token. The first ``MAX_STATES`` states are
    remembered, these are the frequent ones; what lies beyond is worked out again when it is met, ``STRIDE`` bytes at a time."""

    START = (b"", (-1,), (0,), ())

    def __init__(self, ranks: Ranks):
        self.r = ranks
        self.states: dict[tuple[bytes, tuple[int, ...]], int] = {self.START[:2]: 0}
        self.names = [self.START]
        #: state * 256 + byte -> next state, or (next state, emitted tokens)
        self.moves: dict[int, int | tuple[int, tuple[int, ...]]] = {}
        self.finals: dict[int, tuple[int, ...]] = {}

    @staticmethod
    def _path(lasts: tuple[int, ...], starts: tuple[int, ...], at: int) -> tuple[int, ...]:
        """The tokens of the encoding of the prefix of length ``at``."""
        out = []
        while at > 0:
            out.append(lasts[at])
            at = starts[at]
        return tuple(out[::-1])

    def step(self, named: tuple, more: bytes) -> tuple[tuple, tuple[int, ...]]:
        """(next state, emitted tokens) after one byte or several."""
        tail, lasts, starts, live = named[0] + more, list(named[1]), list(named[2]), named[3]
        node, pairs, compatible = self.r.nodes.get, self.r.pairs.get, self.r.compatible
        for n in range(len(named[0]), len(tail)):
            at, still = -1, []
            for k in (*live, n):
                token, begun = node(tail[k:n + 1], (-1, False))
                if at < 0 and token >= 0:  # exactly one token that ends here continues an encoding
                    ok = pairs(lasts[k] << 32 | token)
                    if compatible(lasts[k], token) if ok is None else ok:
                        at = k
                        lasts.append(token)
                        starts.append(k)
                if begun:
                    still.append(k)
            if at < 0:
                raise ValueError(f"byte {tail[n]} is not a token")
            live = still
        # A later token starts at the end or at a live prefix; their encodings agree up to where they meet.
        meet = len(tail)
        for other in live[::-1]:
            while meet != other:
                if meet > other:
                    meet = starts[meet]
                else:
                    other = starts[other]
            if not meet:
                break
        out = self._path(lasts, starts, meet)
        last = lasts[meet] if not live or live[0] == meet else PAST
        return (tail[meet:], (last, *lasts[meet + 1:]), tuple([max(x - meet, 0) for x in starts[meet:]]), tuple([k - meet for k in live])), out

    def _learn(self, state: int, byte: int) -> int | tuple[int, tuple[int, ...]]:
        """Remember a move."""
        named, out = self.step(self.names[state], bytes((byte,)))
        to = self.states.get(named[:2])
        if to is None:
            to = self.states[named[:2]] = len(self.names)
            self.names.append(named)
        move = self.moves[state << 8 | byte] = (to, out) if out else to
        return move

    def encode(self, data: bytes) -> list[int]:
        state, named, out, known, at, n = 0, None, [], self.moves.get, 0, len(data)
        while at < n:
            if named is None:  # in a remembered state
                move = known(state << 8 | data[at])
                if move is None and len(self.names) < MAX_STATES:
                    move = self._learn(state, data[at])
                if move.__class__ is int:
                    state = move
                elif move is not None:
                    state, emitted = move
                    out += emitted
                else:
                    named = self.names[state]
                at += move is not None
            if named is not None:
                named, emitted = self.step(named, data[at:at + STRIDE])
                at += STRIDE
                out += emitted
                state = self.states.get(named[:2])
                if state is not None:
                    named = None
        if named is None:
            done = self.finals.get(state)
            if done is None:
                tail, lasts, starts, _ = self.names[state]
                done = self.finals[state] = self._path(lasts, starts, len(tail))
            out += done
        else:
            out += self._path(named[1], named[2], len(named[0]))
        return out


class Pieces(dict):
    """match of the pattern (str) -> its ids as little-endian 32-bit integers."""

    def __init__(self, ranks: Ranks):
        super().__init__()
        self.ranks, self.fst, self.older = ranks, Transducer(ranks), {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.ranks.ranks.get(data)
            ids = array("I", [whole] if whole is not None else self.fst.encode(data)).tobytes()
            if len(data) > 64:
                return ids
        if len(self) >= CACHE_PIECES // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Utf8Stream:
    """Incremental decoding: ``feed`` returns the whole characters so far, an unfinished one waits."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Bytes at the end that start a character without completing it. Walks back over continuation bytes
        to the lead byte, three at most."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 != 0x80:
                need = 4 if b >= 0xF0 else 3 if b >= 0xE0 else 2 if b >= 0xC0 else 1
                return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self.unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "strict")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "strict")


@functools.lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    with open(path, "rb") as f:
        return Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class Coder:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.find = regex.compile(pattern).findall
        self.pieces = Pieces(self.ranks)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def decode(self, ids: bytes):
        """The text of ids (little-endian 32-bit), piece by piece."""
        numbers, stream, name = memoryview(ids).cast("I"), Utf8Stream(), self.ranks.bytes
        for at in range(0, len(numbers), DECODE_IDS):
            yield stream.feed(b"".join(map(name.__getitem__, numbers[at:at + DECODE_IDS])))
        yield stream.close()


@functools.lru_cache(maxsize=1)
def load_coder(path: str, pattern: str) -> Coder:
    """One coder for a worker's process, so that tasks after the first find its states and pieces."""
    return Coder(path, pattern)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every text. ``path`` is a rank file that
    every executor can read (it comes with an installed package)."""

    def setup():
        coder = load_coder(path, pattern)

        def rows(batch: pa.RecordBatch) -> dict:
            n, ids_sha, out_sha = [], [], []
            for text in batch.column("text").to_pylist():
                ids = coder.encode(text or "")
                back = hashlib.sha256()
                for piece in coder.decode(ids):
                    back.update(piece.encode())
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                out_sha.append(back.hexdigest())
            return {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": out_sha}

        return rows

    return map_slices(docs.select("doc_id", "text"), setup, SCHEMA)


@register("op5_bpe_transducer")
def q_bpe_transducer(spark, sf_dir):
    import public_tokenizers

    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)
