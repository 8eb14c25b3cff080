"""Byte-level BPE by a lazily determinised transducer, and decoding by an incremental UTF-8 machine.

A sequence of tokens is what the merges make of its bytes if and only if each token is made of its own
bytes and no merge crosses the border of two neighbours (``Merges.borders``). So an automaton that has
emitted token ``p`` and has read part of the next one may end that one only where ``p`` allows it, and a
text has one accepted path. Its subset construction is done as texts need it: a state of the
deterministic transducer holds, for each token that may be under way, the place in the trie of tokens
and what was emitted on that path since the paths parted. What all paths agree on is emitted at
once, so output lags by the longest stretch in which another split is still possible, never by the text.

Each match of the pattern that splits texts is encoded by itself; a match that is a token is that token.
Ids of matches seen before are kept, up to ``KEPT`` of them, and so are ``STATES`` states; beyond that
they are built anew. Both only save time.

Defined results of ``encode_documents``: a null or empty text has no tokens and the digests of the empty
string; repeated rows are encoded again; an empty table gives no rows; other columns are ignored. Bytes
that are not UTF-8 are read as U+FFFD. A text is encoded whole, whatever its length.
"""

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybrook.llm.common import id_and_bytes, ship

STATES = 400_000
KEPT = 800_000
KEPT_LENGTH = 64
BLOCK = 4096
NEVER = 1 << 40
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The rules that ranks stand for: neighbours whose joined bytes rank lowest are merged first, from the left."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._borders: dict[int, bool] = {}
        self._spines: tuple[dict[int, list[int]], dict[int, list[int]]] = ({}, {})

    def halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None if the merges don't make it of its bytes."""
        if rank not in self._halves:
            token, ranks = self.tokens[rank], self.ranks
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                merged = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
                least = min(merged)
                if least >= rank:
                    break
                at = merged.index(least)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            made = len(parts) == 2 and all(x in ranks for x in parts)
            self._halves[rank] = (ranks[parts[0]], ranks[parts[1]]) if made else None
        return self._halves[rank]

    def made(self, rank: int) -> bool:
        return len(self.tokens[rank]) == 1 or self.halves(rank) is not None

    def _spine(self, rank: int, side: int) -> list[int]:
        """The tokens that stand at one edge of this one while it is made, from a byte on; none if it isn't made of its bytes."""
        spine = self._spines[side].get(rank)
        if spine is None:
            if len(self.tokens[rank]) == 1:
                spine = [rank]
            else:
                halves = self.halves(rank)
                spine = [*self._spine(halves[side], side), rank] if halves else []
            self._spines[side][rank] = spine
        return spine

    def borders(self, left: int, right: int) -> bool:
        """True if no merge joins the end of ``left`` with the start of ``right`` while both are made."""
        key = left << 32 | right
        apart = self._borders.get(key)
        if apart is None:
            apart = self._borders[key] = self._apart(self._spine(left, 1), self._spine(right, 0))
        return apart

    def _apart(self, xs: list[int], ys: list[int]) -> bool:
        tokens, ranks, i, j = self.tokens, self.ranks, 0, 0
        if not ys:
            return False
        while True:
            next_x = xs[i + 1] if i + 1 < len(xs) else NEVER
            next_y = ys[j + 1] if j + 1 < len(ys) else NEVER
            joined = ranks.get(tokens[xs[i]] + tokens[ys[j]], NEVER)
            # Of merges of one rank the leftmost is first.
            if joined < next_x and joined <= next_y and joined < NEVER:
                return False
            if next_x == next_y == NEVER:
                return True
            if next_x <= next_y:
                i += 1
            else:
                j += 1


class Transducer:
    """Bytes to token ids, deterministic; states and steps are built when first met."""

    def __init__(self, merges: Merges, most: int = STATES):
        self.merges, self.most = merges, most
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for rank, token in enumerate(merges.tokens):
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = self.children[node][byte]
            if token:
                self.ends[node] = rank
        self._restart()

    def _restart(self) -> None:
        # A state: the token emitted last, and for each path its tokens since and its place in the trie.
        self.start = (-1, (((), 0),))
        self.numbers = {self.start: 0}
        self.states = [self.start]
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def _step(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, paths = self.states[number]
        children, merges, after, done = self.children, self.merges, [], None
        for emitted, node in paths:
            if (node := children[node].get(byte)) is None:
                continue
            if children[node]:
                after.append((emitted, node))
            if done is None and (token := self.ends[node]) >= 0:
                before = emitted[-1] if emitted else last
                if merges.made(token) if before < 0 else merges.borders(before, token):
                    done = (*emitted, token)
        if done is None:
            raise ValueError(f"byte {byte} is in no token")
        common = len(done)
        for emitted, _ in after:
            if emitted[:common] != done[:common]:
                common = next(i for i, x in enumerate(done) if i >= len(emitted) or emitted[i] != x)
                if not common:
                    break
        out = done[:common]
        # The path that has just ended a token is last; it is the one to accept.
        after.append((done, 0))
        rest = tuple([(emitted[common:], node) for emitted, node in after]) if common else tuple(after)
        # The token before is asked for only by a path that has emitted nothing since.
        state = ((out[-1] if out else last) if any([not emitted for emitted, _ in rest]) else -1, rest)
        after_number = self.numbers.get(state)
        if after_number is None:
            after_number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        step = self.steps[number][byte] = (after_number, out)
        return step

    def feed(self, data: Iterable[int]) -> Iterator[int]:
        """Tokens as soon as they are certain; the rest when ``data`` ends."""
        if len(self.states) > self.most:
            self._restart()
        number = 0
        for byte in data:
            number, out = self.steps[number].get(byte) or self._step(number, byte)
            yield from out
        yield from self.states[number][1][-1][0]

    def encode(self, data: bytes) -> list[int]:
        if len(self.states) > self.most:
            self._restart()
        number, steps, found = 0, self.steps, []
        for byte in data:
            step = steps[number].get(byte) or self._step(number, byte)
            number = step[0]
            if step[1]:
                found += step[1]
        found += self.states[number][1][-1][0]
        return found


# Well-formed UTF-8 by the state before a byte: how many bytes are to come, and the bounds of the next one.
_FIRST = (
    (0x00, 0x7F, None), (0xC2, 0xDF, (1, 0x80, 0xBF)), (0xE0, 0xE0, (2, 0xA0, 0xBF)), (0xE1, 0xEC, (2, 0x80, 0xBF)),
    (0xED, 0xED, (2, 0x80, 0x9F)), (0xEE, 0xEF, (2, 0x80, 0xBF)), (0xF0, 0xF0, (3, 0x90, 0xBF)), (0xF1, 0xF3, (3, 0x80, 0xBF)),
    (0xF4, 0xF4, (3, 0x80, 0x8F)),
)


class Decoder:
    """Token ids to text as they come; bytes of a character that is not complete yet are held back.

    A stretch that can't be UTF-8 gives one U+FFFD, as in Python's decoder.
    """

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.first = {b: then for low, high, then in _FIRST for b in range(low, high + 1)}
        # Tokens that are whole characters by themselves.
        self.whole = np.array([self._is_whole(x) for x in tokens], dtype=bool)

    @staticmethod
    def _is_whole(token: bytes) -> bool:
        try:
            token.decode("utf-8")
        except UnicodeDecodeError:
            return False
        return True

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        held, expects, ids = bytearray(), None, iter(ids)
        while block := list(islice(ids, BLOCK)):
            broken = [*np.flatnonzero(~self.whole[np.array(block)]).tolist(), len(block)]
            text, at = [], 0
            for stop in broken:
                # Whole characters need no machine; those that interrupt an unfinished one do.
                while expects is not None and at < stop:
                    expects = self._feed(self.tokens[block[at]], held, expects, text)
                    at += 1
                if at < stop:
                    text.append(self.bytes_of(block[at:stop]).decode("utf-8"))
                if stop < len(block):
                    expects = self._feed(self.tokens[block[stop]], held, expects, text)
                at = stop + 1
            if text:
                yield "".join(text)
        if held:
            yield "�"

    def _feed(self, token: bytes, held: bytearray, expects: tuple | None, text: list[str]) -> tuple | None:
        """Add to ``text`` what the token's bytes complete; ``held`` and the state returned stand for the rest."""
        for byte in token:
            if expects is not None:
                left, low, high = expects
                if low <= byte <= high:
                    held.append(byte)
                    expects = (left - 1, 0x80, 0xBF) if left > 1 else None
                    if expects is None:
                        text.append(held.decode("utf-8"))
                        held.clear()
                    continue
                text.append("�")
                held.clear()
                expects = None
            if byte in self.first:
                expects = self.first[byte]
                if expects is None:
                    text.append(chr(byte))
                else:
                    held.append(byte)
            else:
                text.append("�")
        return expects

    def bytes_of(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Kept(dict):
    """Match of the pattern to its ids as little-endian 32-bit numbers."""

    def __init__(self, codec: "Codec"):
        super().__init__()
        self.codec = codec

    def __missing__(self, match: str) -> bytes:
        found = self.codec.match_ids(match.encode("utf-8"))
        ids = pack(f"<{len(found)}I", *found)
        if len(match) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.clear()
            self[match] = ids
        return ids


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.merges = Merges(ranks)
        self.transducer = Transducer(self.merges)
        self.decoder = Decoder(self.merges.tokens)
        self.split = regex.compile(pattern).findall
        # In ASCII text the classes of the pattern are these, and the standard library finds them sooner.
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.split_ascii = None if r"\p" in plain else re.compile(plain, re.ASCII).findall
        self.names = [str(i) for i in range(len(self.merges.tokens))]
        self.kept = _Kept(self)

    def match_ids(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return self.transducer.encode(data) if whole is None else [whole]

    def encode(self, text: str) -> np.ndarray:
        split = self.split_ascii if self.split_ascii and text.isascii() else self.split
        return np.frombuffer(b"".join(map(self.kept.__getitem__, split(text))), dtype="<u4")


@cache
def codec(path: str, pattern: str) -> Codec:
    """One per Python worker and vocabulary."""
    return Codec(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Digests of each text's ids and of what they decode to; ``keep_ids`` adds the ids."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32())] * keep_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = own.encode(body.as_py().decode("utf-8", "replace"))
                numbers = ids.tolist()
                decoded = hashlib.sha256()
                for text in own.decoder.stream(numbers):
                    decoded.update(text.encode("utf-8"))
                said = hashlib.sha256(" ".join(map(own.names.__getitem__, numbers)).encode()).hexdigest()
                rows.append((doc, len(ids), said, decoded.hexdigest(), *[ids.astype(np.int32)] * keep_ids))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=k) for c, k in zip(columns, kinds, strict=True)], names=names)

    ship(docs.sparkSession)
    return id_and_bytes(docs).mapInArrow(encode, ENCODED + ", ids array<int>" * keep_ids)
