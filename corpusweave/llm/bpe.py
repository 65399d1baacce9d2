"""Byte-level BPE as a streaming transducer, and its incremental decoder.

Encoding never looks at a whole piece at once. For every prefix of a piece the
encoding of that prefix ends in exactly one token; it is the one that fits the
last token of the prefix before it, and two tokens fit if no merge across their
border comes before the merges that made them. So each byte read costs one step
and one stored position.

A token may be emitted once it is stable. Every encoding of the whole input has
a border among the last ``longest`` positions read, ``longest`` being the longest
token, and up to that border it is the encoding of that prefix: tokens that all
these prefixes share are final. How far behind the reader they can lie is bounded
by the merge list itself (``sufficient_lookahead``): a merge is only undone by an
earlier one that takes its left part out of the right part of the first, so
chains of such merges descend in rank and their lengths add up to a bound. The
transducer holds that much, however long its input.

Pieces are cut as the tokenizer's own pattern cuts them, found for a block of
texts at a time from the classes of its characters. Each distinct piece of a group
of blocks is encoded once, in sorted order: the transducer goes back to the prefix
that a piece shares with the one before it and reads only the rest. A border lies
wherever white space follows anything else, so a long text is cut there and read
in parts.
"""

from __future__ import annotations

import codecs
import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PART = 1 << 16  # tokens decoded at a time
_BLOCK = 1 << 20  # characters cut into pieces at a time
_GROUP = 1 << 23  # characters whose distinct pieces are encoded together
_ROW = 32  # what a part or piece counts besides its characters
_LONG = 4096  # characters from which a piece is streamed, not kept
_KEPT = 150_000  # entries of the table of borders
_OUT = 8 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class MergeList:
    """Tokens and merges of a byte-level BPE model."""

    def __init__(self, tokens: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int] | None = None):
        self.special = special or {}
        back = {c: b for b, c in enumerate(byte_symbols())}
        as_bytes = lambda t: bytes(back[c] for c in t)
        names = {**tokens}
        self.ids = {as_bytes(t): i for t, i in names.items() if all(c in back for c in t) and t not in self.special}
        size = max([*names.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for b, i in self.ids.items():
            self.bytes[i] = b
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        # rank -1: single bytes, which no merge makes
        self.rank, self.parts, self.pair = [-1] * size, [(-1, -1)] * size, {}
        for rank, (a, b) in enumerate(merges):
            x, y, made = tokens[a], tokens[b], tokens[a + b]
            self.pair.setdefault(x << 32 | y, rank)
            if self.rank[made] < 0 and len(self.bytes[made]) > 1:
                self.rank[made], self.parts[made] = rank, (x, y)
        self.longest = max(map(len, self.ids), default=1)
        self.lengths = [len(b) for b in self.bytes]
        self._fits: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._layout = None
        self.sufficient_lookahead = self._lookahead()
        # Tokens that their own bytes encode to: no other can end a prefix.
        self.ending = {b: i for b, i in self.ids.items() if self.whole(i)}
        # These, and -1 for whatever else a token begins with.
        self.begun = {b[:k]: -1 for b in self.ending for k in range(1, len(b))} | self.ending
        self.packed = [i.to_bytes(4, "little") for i in range(size)]

    @classmethod
    def from_file(cls, path: str) -> MergeList:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        return cls(spec["model"]["vocab"], merges, {t["content"]: t["id"] for t in spec.get("added_tokens", [])})

    def _lookahead(self) -> int:
        """Bytes that can be read past a token's end before it is settled.

        ``reach[x]``: of the merges met so far whose left part is ``x``, the
        farthest that one and the chain after it extend to the right.
        """
        order = sorted((t for t in range(len(self.rank)) if self.rank[t] >= 0), key=self.rank.__getitem__)
        reach: dict[int, int] = {}
        most = 0
        for made in order:
            left, right = self.parts[made]
            far, at = 0, right
            while at >= 0:  # the tokens that end the right part
                far = max(far, reach.get(at, 0))
                at = self.parts[at][1]
            far += len(self.bytes[right])
            reach[left] = max(reach.get(left, 0), far)
            most = max(most, far)
        return most + self.longest

    def layout(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes in one array, with each one's start and length."""
        if self._layout is None:
            lengths = np.array([len(b) for b in self.bytes])
            self._layout = np.frombuffer(b"".join(self.bytes), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths
        return self._layout

    def fits(self, a: int, b: int) -> bool:
        """Whether ``a, b`` is the encoding of the two tokens' bytes.

        Walks back through the merges that made both, later ones first, and asks
        at each border whether its own merge would have come sooner. Equal ranks
        merge from the left.
        """
        key = a << 32 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > _KEPT:
                self._fits.clear()
            known = self._fits[key] = self._border(a, b)
        return known

    def _border(self, x: int, y: int) -> bool:
        ends_x = ends_y = len(self.pair)
        pair, rank, parts = self.pair, self.rank, self.parts
        while True:
            own = pair.get(x << 32 | y)
            if own is not None and own < ends_x and own <= ends_y:
                return False
            rx, ry = rank[x], rank[y]
            if rx < 0 and ry < 0:
                return True
            if rx > ry:
                ends_x, x = rx, parts[x][1]
            else:
                ends_y, y = ry, parts[y][0]

    def whole(self, token: int) -> bool:
        """Whether the token's bytes encode to the token itself."""
        known = self._whole.get(token)
        if known is None:
            left, right = self.parts[token]
            # Parts fit up to the merge of this token, which must be the first across their border.
            known = left < 0 or (self.whole(left) and self.whole(right) and self._made(left, right, self.rank[token]))
            self._whole[token] = known
        return known

    def _made(self, x: int, y: int, at: int) -> bool:
        ends_x = ends_y = len(self.pair)
        first = True
        while True:
            own = self.pair.get(x << 32 | y)
            if not first and own is not None and own < ends_x and own <= ends_y:
                return False
            first = False
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                return True
            if rx > ry:
                ends_x, x = rx, self.parts[x][1]
            else:
                ends_y, y = ry, self.parts[y][0]


class Transducer:
    """Tokens of one piece, fed in parts; ``feed`` gives those that are stable."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.data = b""  # bytes after the last emitted token
        self.last: list[int] = [-1]  # token that ends the prefix at each position; first the last emitted one
        self.open: list[int] = [0]  # where the longest suffix of each prefix that begins a token begins

    def _extend(self, part: bytes) -> None:
        m, last, open_ = self.merges, self.last, self.open
        begun, known = m.begun.get, m._fits.get
        start, end = open_[-1], len(self.data)
        data = self.data + part
        while end < len(data):
            end += 1
            # No token that reaches this far begins before the longest suffix that begins one.
            while (token := begun(data[start:end])) is None:
                start += 1
                if start == end:
                    raise ValueError("a byte has no token")
            at = start
            while True:
                if token is not None and token >= 0:
                    prior = last[at]
                    if prior < 0:
                        break
                    fit = known(prior << 32 | token)
                    if fit or (fit is None and m.fits(prior, token)):
                        break
                at += 1
                if at == end:
                    raise ValueError("a byte has no token")
                token = begun(data[at:end])
            last.append(token)
            open_.append(start)
        self.data = data

    def whole(self, piece: bytes) -> list[int]:
        """Tokens of a piece read at once, by a transducer that reads nothing else.
        What the piece before began with as well is not read again."""
        same = 0
        for a, b in zip(piece, self.data, strict=False):
            if a != b:
                break
            same += 1
        self.data = self.data[:same]
        del self.last[same + 1 :], self.open[same + 1 :]
        self._extend(piece[same:])
        return self._path(len(piece))

    def _path(self, end: int, stop: int = 0) -> list[int]:
        found, last, lengths = [], self.last, self.merges.lengths
        while end > stop:
            token = last[end]
            found.append(token)
            end -= lengths[token]
        return found[::-1]

    def feed(self, part: bytes) -> list[int]:
        self._extend(part)
        # The prefix that all of the last positions share.
        n, lengths = len(self.data), self.merges.lengths
        at = set(range(max(0, n - self.merges.longest + 1), n + 1))
        while len(at) > 1:
            far = max(at)
            at.remove(far)
            at.add(far - lengths[self.last[far]])
        stable = at.pop()
        return self._emit(stable)

    def _emit(self, upto: int) -> list[int]:
        found = self._path(upto)
        if found:
            self.data = self.data[upto:]
            self.last = [found[-1], *self.last[upto + 1 :]]
            self.open = [0, *(max(0, at - upto) for at in self.open[upto + 1 :])]
        return found

    def close(self) -> list[int]:
        return self._emit(len(self.data))


LETTER, NUMBER, OTHER, SPACE = range(4)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class that the pattern gives each code point."""
    found, every = np.full(0x110000, OTHER, dtype=np.uint8), np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            found[m.start() : m.end()] = kind
    return found


def cuts(code: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where ``PATTERN`` begins a match in texts laid end to end: ``code`` has their
    code points, ``begins`` the first position of each. As the pattern would, but for
    all positions at once:

    * matches are runs of a class;
    * a run of white space before another character gives its last one away: a blank
      to that character's match, any other stands alone;
    * an apostrophe that is a match alone takes the letters of a contraction.
    """
    kind = classes()[code]
    begin = np.zeros(len(code) + 1, dtype=bool)
    begin[begins] = True
    start = begin.copy()
    start[1:-1] |= kind[1:] != kind[:-1]
    after = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begin[1:-1]) + 1
    start[after - 1] = True
    start[after[code[after - 1] == 0x20]] = False
    sign = np.flatnonzero((code[:-1] == 0x27) & start[:-2] & ~begin[1:-1])
    first = code[sign + 1]
    one = sign[np.isin(first, [ord(c) for c in "stmd"])]
    pair = sign[np.isin(first, [ord(c) for c in "rvl"]) & (sign + 2 < len(code)) & ~begin[sign + 2]]
    pair = pair[np.isin(code[pair + 1] << 8 | code[pair + 2], [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])]
    for at, letters in ((one, 1), (pair, 2)):
        start[at + 1] = False
        start[at + 1 + letters] = True
    return np.flatnonzero(start[:-1])


class Block(NamedTuple):
    """Pieces of some parts: part ``k`` has those from ``borders[k]`` to ``borders[k + 1]``."""

    parts: list[tuple[int, int | None]]  # number of the text, and its id if the part is a special token
    borders: np.ndarray
    pieces: pa.DictionaryArray
    size: int


class Encoder:
    """Packed little-endian ids of texts."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.short = Transducer(merges)
        special = sorted(merges.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def _piece(self, piece: str) -> bytes:
        return np.array(self.short.whole(piece.encode()), dtype="<u4").tobytes()

    def _streamed(self, piece: str) -> Iterator[bytes]:
        t = Transducer(self.merges)
        step = max(1024, self.merges.sufficient_lookahead)
        for at in range(0, len(piece), step):
            if ids := t.feed(piece[at : at + step].encode()):
                yield np.array(ids, dtype="<u4").tobytes()
        yield np.array(t.close(), dtype="<u4").tobytes()

    def _parts(self, texts: Iterable[str]) -> Iterator[tuple[int, str, int | None]]:
        """Parts of each text, one at least; a special token's own string in the text is that token."""
        for n, text in enumerate(texts):
            for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
                if k % 2:
                    yield n, "", self.merges.special[part]
                else:
                    yield from ((n, p, None) for p in (parts_of(part, _BLOCK) if part else [""]))

    def _blocks(self, texts: Iterable[str]) -> Iterator[Block]:
        held, size = [], 0
        for n, part, special in self._parts(texts):
            if len(part) > 2 * _BLOCK:
                yield self._block(held, size)
                held, size = [], 0
                yield from self._unbroken(n, part)
                continue
            held.append((n, part, special))
            size += len(part) + _ROW
            if size >= _BLOCK:
                yield self._block(held, size)
                held, size = [], 0
        yield self._block(held, size)

    def _block(self, held: list[tuple[int, str, int | None]], size: int) -> Block:
        text = "".join(part for _, part, _ in held)
        begins = np.cumsum([0, *(len(part) for _, part, _ in held)])
        data, code = text.encode(), np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        at = cuts(code, begins)
        borders = np.searchsorted(at, begins)
        if len(data) > len(text):  # from characters to bytes
            at = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)[at]
        at = np.append(at, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        return Block([(n, special) for n, _, special in held], borders, pieces.dictionary_encode(), size)

    def _unbroken(self, n: int, part: str) -> Iterator[Block]:
        """Blocks of a part that has no border for longer than a block, match by match."""
        pieces, size = [], 0
        for found in chain(regex.finditer(PATTERN, part), [None]):
            if found:
                pieces.append(found[0])
                size += len(found[0]) + _ROW
            if size >= _BLOCK or not found:
                yield Block([(n, None)], np.array([0, len(pieces)]), pa.array(pieces, pa.string()).dictionary_encode(), size)
                pieces, size = [], 0

    def _group(self, blocks: list[Block]) -> Iterator[tuple[int, bytes]]:
        """Ids of each part; every distinct piece of the blocks is encoded once."""
        chunks = pa.chunked_array([b.pieces for b in blocks]).unify_dictionaries().chunks
        distinct = chunks[0].dictionary
        order = pc.sort_indices(distinct)
        packed = [self._piece(p) if len(p) < _LONG else b"".join(self._streamed(p)) for p in distinct.take(order).to_pylist()]
        ids = np.frombuffer(b"".join(packed), dtype="<u4")
        lengths = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        starts, counts = np.empty_like(lengths), np.empty_like(lengths)
        starts[order], counts[order] = np.cumsum(lengths) - lengths, lengths
        for block, chunk in zip(blocks, chunks, strict=True):
            which = chunk.indices.to_numpy()
            ends = np.cumsum(np.append(0, counts[which]))
            found = ids[np.repeat(starts[which] - ends[:-1], counts[which]) + np.arange(ends[-1])]
            borders = ends[block.borders].tolist()
            for (n, special), a, b in zip(block.parts, borders, borders[1:], strict=False):
                yield n, found[a:b].tobytes() if special is None else self.merges.packed[special]

    def _encoded(self, texts: Iterable[str]) -> Iterator[tuple[int, bytes]]:
        """Ids of the texts, part by part, each with the number of its text."""
        held, size = [], 0
        for block in self._blocks(texts):
            held.append(block)
            size += block.size
            if size >= _GROUP:
                yield from self._group(held)
                held, size = [], 0
        if held:
            yield from self._group(held)

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of one text in parts of bounded size."""
        return (ids for _, ids in self._encoded([text]))

    def encode_all(self, rows: Iterable[tuple[Any, str]]) -> Iterator[tuple[Any, bytes]]:
        """Each key with the ids of its text; many texts are read before the first comes out."""
        keys: deque = deque()

        def texts() -> Iterator[str]:
            for key, text in rows:
                keys.append(key)
                yield text

        for _, found in groupby(self._encoded(texts()), key=itemgetter(0)):
            yield keys.popleft(), b"".join(ids for _, ids in found)


def parts_of(text: str, size: int = _PART) -> Iterator[str]:
    """Parts of at least ``size`` characters, cut where white space follows other text."""
    cut = regex.compile(r"(?<=\S)(?=\s)")
    at = 0
    while len(text) - at > size:
        found = cut.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    if at < len(text):
        yield text[at:] if at else text


class Decoder:
    """Text of token ids, as the bytes allow: a character split over tokens
    appears with its last byte, bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, merges: MergeList):
        self.flat, self.starts, self.lengths = merges.layout()
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.state.decode(self.flat[at].tobytes())

    def close(self) -> str:
        return self.state.decode(b"", final=True)


def decoded(merges: MergeList, packed: bytes) -> str:
    d, ids = Decoder(merges), np.frombuffer(packed, dtype="<u4")
    found = [d.feed(ids[at : at + _PART]) for at in range(0, len(ids), _PART)]
    return "".join([*found, d.close()])


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(MergeList.from_file(path))


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size."""
    held, bytes_ = [], 0
    pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
    for row in rows:
        held.append(row)
        bytes_ += size(row)
        if bytes_ > _OUT:
            yield pack()
            held, bytes_ = [], 0
    if held:
        yield pack()


def _run(path: str, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(path)

        def texts():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), (text.as_py() or "" for text in batch.column(1)), strict=True)

        rows = ((doc_id, len(ids) // 4, ids, decoded(e.merges, ids) if with_text else None) for doc_id, ids in e.encode_all(texts()))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
        yield from _batches(rows, ["doc_id", "n_tokens", "ids", "decoded"], kinds, lambda r: len(r[2]) + len(r[3] or "") + 64)

    return run


def encode(documents: DataFrame, path: str, round_trip: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` per row; ``ids`` are little-endian unsigned 32-bit
    numbers. ``round_trip`` adds ``decoded``, the text of the ids. Null texts are
    empty and have no tokens. Repeated rows and null doc_ids stay; extra columns go."""
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    found = rows.mapInArrow(_run(path, round_trip), "doc_id long, n_tokens long, ids binary, decoded string")
    return found if round_trip else found.drop("decoded")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded(doc_id, n_tokens, ids)`` with ``decoded``, the text of the ids; null ids give an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _encoder(path).merges

        def rows():
            for batch in batches:
                for doc_id, n, ids in zip(*(batch.column(i) for i in range(3)), strict=True):
                    packed = ids.as_py()
                    yield doc_id.as_py(), n.as_py(), packed, decoded(merges, packed or b"")

        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
        yield from _batches(rows(), ["doc_id", "n_tokens", "ids", "decoded"], kinds, lambda r: len(r[2] or b"") + len(r[3]) + 64)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(documents: DataFrame, path: str) -> DataFrame:
    """Digests of each document's ids and of the text they decode to."""
    return encode(documents, path, round_trip=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )
