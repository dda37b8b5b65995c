"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs that form a piece, taken by
score, then from the left. Where no piece has a word-start mark after another
character, no merge crosses the start of a word, nor a character that is in no
longer piece (digits, line ends), so a text is merged word by word, words of one
batch side by side: the agendas of words of similar length are the rows of an
array, and each step takes the first of every row. A longer word has a heap.
Merged words are remembered (about ``CACHE`` of them a worker). Characters
without a piece become their UTF-8 bytes. Every text is also encoded by the
sentencepiece library; ``agrees`` says of each row if the two are the same, and
where they are not the library's ids count.

Defined results: a null text is empty: no ids, empty decoded text; an empty
table gives no rows; repeated rows get equal values; a null doc_id is passed on;
extra columns are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE = 400_000
#: Words up to these lengths are merged side by side.
WIDTHS = (8, 12, 20, 40)
#: Characters of the texts that are encoded together (a longer text alone).
TOGETHER = 1 << 20
#: Symbols of the words that are merged at a time.
_AREA = 1 << 18
_START = re.compile(f"(?<![ {SPACE}])[ {SPACE}]")
_PLACE = (1 << 40) - 1
_ALONE, _JOINS, _STARTS = 0, 1, 2  # a character that is in no longer piece; that is in one; a word-start mark
_NO_PAIR = np.iinfo(np.int32).max
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0xD6E8FEB86659FD93, i, 1 << 64) for i in range(64)], np.uint64)
MODEL = "piece_bpe_32k.model"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class _Table:
    """Numbers by 64-bit keys, none negative, by open addressing in arrays."""

    def __init__(self, room: int):
        bits = max(4, (2 * room).bit_length())
        self.shift, self.mask, self.used = np.uint64(64 - bits), (1 << bits) - 1, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * _ODD >> self.shift).astype(np.int64)

    def put(self, key: np.ndarray, value: np.ndarray) -> None:
        """key: none twice, none there yet."""
        self.used += len(key)
        at = self._home(key)
        while len(key):
            free = self.keys[at] < 0
            self.keys[at[free]], self.values[at[free]] = key[free], value[free]  # of several for one place, one gets it
            lost = self.keys[at] != key
            key, value, at = key[lost], value[lost], (at[lost] + 1) & self.mask

    def find(self, key: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        at = self._home(key)
        there = self.keys[at]
        out = np.where(there == key, self.values[at], -1)
        left = np.flatnonzero((there != key) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there = self.keys[at[left]]
            hit = there == key[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


class _Store:
    """Ids of remembered words, back to back."""

    def __init__(self):
        self.n = self.used = 0
        self.ids, self.start, self.size = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def add(self, ids: np.ndarray, size: np.ndarray) -> int:
        """Returns the number of the first word added."""
        first = self.n
        self.ids = self._room(self.ids, self.used, len(ids))
        self.start, self.size = (self._room(x, first, len(size)) for x in (self.start, self.size))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[first : first + len(size)] = self.used + np.cumsum(size) - size
        self.size[first : first + len(size)] = size
        self.used += len(ids)
        self.n += len(size)
        return first

    @staticmethod
    def _room(x: np.ndarray, used: int, more: int) -> np.ndarray:
        return x if used + more <= len(x) else np.concatenate((x[:used], np.empty(used + 2 * more, x.dtype)))

    def take(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words back to back, and the number of ids of each."""
        size = self.size[words]
        return self.ids[np.repeat(self.start[words] - np.cumsum(size) + size, size) + np.arange(size.sum())], size


class Codec:
    """A merge-type model with byte fallback, identity normalisation and a space before the text."""

    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids, self.bytes, scores = {}, {}, {}
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece], scores[piece] = i, lib.get_score(i)
        order = {score: r for r, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: order[score] for piece, score in scores.items()}
        # a character that is in no longer piece stands alone; a word-start mark begins a word
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.kind = np.full(0x110000, _ALONE, np.uint8)
        self.kind[[ord(x) for p in self.ids if len(p) > 1 for x in p]] = _JOINS
        self.kind[ord(SPACE)] = _STARTS
        halves = ((piece[:k], piece[k:]) for piece in self.ids for k in range(1, len(piece)))
        self.n = lib.get_piece_size()
        made = {self.ids[a] * self.n + self.ids[b]: self.ids[a + b] for a, b in halves if a in self.ids and b in self.ids}
        self.pairs = _Table(2 * len(made))
        self.pairs.put(np.array(list(made), np.int64), np.array(list(made.values()), np.int32))
        self.rank_of = np.full(lib.get_piece_size() + 1, _NO_PAIR, np.int32)  # the last is that of no piece, -1
        self.rank_of[list(self.ids.values())] = list(self.rank.values())
        self.letter = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.letter[ord(piece)] = i
        decimals = [str(i).encode() + b"," for i in range(lib.get_piece_size())]
        self.decimal_size = np.array([len(x) for x in decimals])
        self.decimal = np.zeros((len(decimals), self.decimal_size.max()), np.uint8)
        for row, x in zip(self.decimal, decimals, strict=True):
            row[: len(x)] = list(x)
        self._forget()

    def _forget(self) -> None:
        self.seen, self.store = _Table(2 * CACHE), _Store()

    def _pieces(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each two make, or -1; a and b may be -1."""
        key = a.astype(np.int64) * self.n + b
        key[(a < 0) | (b < 0)] = -2
        return self.pairs.find(key)

    def merge(self, word: str) -> tuple[int, ...]:
        """The agenda holds rank and place of a pair in one number; what has changed meanwhile is passed over."""
        n, rank = len(word), self.rank.get
        symbols: list[str | None] = list(word)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [r << 40 | i for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            top = heapq.heappop(agenda)
            a = top & _PLACE
            b = right[a]
            if b >= n or symbols[a] is None or rank(piece := symbols[a] + symbols[b]) != top >> 40:
                continue
            symbols[a], symbols[b] = piece, None
            right[a] = c = right[b]
            if c < n:
                left[c] = a
                if (r := rank(piece + symbols[c])) is not None:
                    heapq.heappush(agenda, r << 40 | a)
            if (c := left[a]) >= 0 and (r := rank(symbols[c] + piece)) is not None:
                heapq.heappush(agenda, r << 40 | c)
        out: list[int] = []
        for s in symbols:
            if s is not None:
                i = self.ids.get(s)
                out += [i] if i is not None else [self.bytes[x] for x in s.encode("utf-8", "surrogatepass")]
        return tuple(out)

    def _side_by_side(self, symbols: np.ndarray) -> np.ndarray:
        """symbols: a word a row, -1 after its end. The pieces of each, -1 after the last."""
        n, width = symbols.shape
        s = np.column_stack((symbols, np.full(n, -1, np.int32)))
        p = np.full((n, width), -1, np.int32)  # of each symbol and the next, the piece they make
        p[:, :-1] = self._pieces(s[:, : width - 1].ravel(), s[:, 1:width].ravel()).reshape(n, -1)
        p = np.column_stack((p, np.full(n, -1, np.int32)))
        r = self.rank_of[p]
        row, column = np.arange(n), np.arange(width)
        while len(row):
            j = r.argmin(axis=1)  # by score, then from the left
            live = r[np.arange(len(row)), j] < _NO_PAIR
            if not live.all():
                symbols[row[~live]] = s[~live, :width]
                row, j, s, p, r = row[live], j[live], s[live], p[live], r[live]
            i = np.arange(len(row))
            new = p[i, j]
            after = column + (column > j[:, None]) + (i * (width + 1))[:, None]
            s[:, :width], p[:, :width], r[:, :width] = np.take(s, after), np.take(p, after), np.take(r, after)
            s[i, j] = new
            p[i, j] = self._pieces(new, s[i, j + 1])
            r[i, j] = self.rank_of[p[i, j]]
            k = np.flatnonzero(j > 0)
            p[k, j[k] - 1] = self._pieces(s[k, j[k] - 1], new[k])
            r[k, j[k] - 1] = self.rank_of[p[k, j[k] - 1]]
        return symbols

    def merge_all(self, letters: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """letters: pieces of one character, some stretches of which are words. Ids word by word, and how many of each."""
        of: list[np.ndarray] = []  # numbers of words, then their ids
        ids: list[np.ndarray] = []
        least = 0
        for width in WIDTHS:
            every = np.flatnonzero((length > least) & (length <= width))
            for chosen in (every[at : at + _AREA // width] for at in range(0, len(every), _AREA // width)):
                at = np.arange(width)
                symbols = np.where(at < length[chosen, None], letters[np.minimum(begin[chosen, None] + at, len(letters) - 1)], -1)
                done = self._side_by_side(symbols)
                there = done >= 0
                of.append(np.repeat(chosen, there.sum(axis=1)))
                ids.append(done[there])
            least = width
        if not of:
            return np.zeros(0, np.int32), np.zeros(len(length), np.int64)
        owner = np.concatenate(of)
        return np.concatenate(ids)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(length))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back, and the number of ids of each.

        Remembered words are looked up by a 64-bit hash.
        """
        ends = np.cumsum([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        line = "".join(SPACE + t for t in texts if t)
        ids, begin, size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = 0
        while at < len(line):
            cut = _START.search(line, at + TOGETHER) if self.splits else None
            upto = cut.start() if cut else len(line)
            found = self._encoded(line[at:upto], ends[(ends > at) & (ends < upto)] - at)
            for all_of, part in zip((ids, begin, size), (found[0], found[1] + at, found[2]), strict=True):
                all_of.append(part)
            at = upto
        upto = np.concatenate(([0], np.cumsum(np.concatenate(size))))
        return np.concatenate(ids), np.diff(upto[np.searchsorted(np.concatenate(begin), np.concatenate(([0], ends)))])

    def _encoded(self, line: str, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a line back to back, starts of its words, and how many ids each has; a word starts at each break."""
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(codes == 32, np.uint32(ord(SPACE)), codes)
        kind = self.kind[codes]
        starts = np.zeros(len(codes), bool)
        if self.splits:
            starts = kind == _ALONE
            starts[1:] |= (kind[1:] != kind[:-1]) & ((kind[1:] == _STARTS) | (kind[:-1] == _ALONE))
        starts[0] = True
        starts[breaks] = True
        begin = np.flatnonzero(starts)
        length = np.diff(np.append(begin, len(codes)))
        letters = self.letter[codes]
        mixed = (codes + np.uint64(1)) * _ODD
        mixed = (mixed ^ mixed >> np.uint64(29)) * _POWERS[(np.arange(len(codes)) - np.repeat(begin, length)) % len(_POWERS)]
        key = np.add.reduceat(mixed, begin)
        key = ((key ^ key >> np.uint64(32)) * _ODD >> np.uint64(1)).view(np.int64)
        odd = (length > WIDTHS[-1]) | (np.minimum.reduceat(letters, begin) < 0)
        place = self.seen.find(key)
        if (new := np.flatnonzero((place < 0) & ~odd)).size:
            if self.seen.used >= CACHE:
                self._forget()
                new = np.flatnonzero(~odd)
            keys, first = np.unique(key[new], return_index=True)
            first = new[first]
            at = self.store.add(*self.merge_all(letters, begin[first], length[first]))
            places = np.arange(at, at + len(keys), dtype=np.int32)
            if self.seen.used + len(keys) <= 2 * CACHE:
                self.seen.put(keys, places)
            place[new] = places[np.searchsorted(keys, key[new])]
        if odd.any():
            alone: dict[str, int] = {}
            for i in np.flatnonzero(odd).tolist():
                word = codes[begin[i] : begin[i] + length[i]].tobytes().decode("utf-32-le", "surrogatepass")
                if word not in alone:
                    ids = self.merge(word)
                    alone[word] = self.store.add(np.array(ids, np.int32), np.array([len(ids)]))
                place[i] = alone[word]
        ids, size = self.store.take(place)
        if self.store.used > 16 * CACHE:
            self._forget()
        return ids, begin, size

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Decimal ids, a comma after each, as bytes."""
        return self.decimal[ids][np.arange(self.decimal.shape[1]) < self.decimal_size[ids, None]]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


@lru_cache(1)
def _codec(model: bytes) -> Codec:
    """One a worker, so that its words are remembered from task to task."""
    return Codec(model)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids, decoded, agrees. The model file is read by the driver and sent along (0.5 MB)."""
    return _run(docs, model, "doc_id long, ids array<int>, decoded string, agrees boolean", _full)


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, agrees."""
    return _run(docs, model, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean", _digest)


def _full(codec: Codec, ids: np.ndarray, size: np.ndarray, decoded: list[str]) -> list[pa.Array]:
    upto = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
    return [pa.ListArray.from_arrays(upto, pa.array(ids, pa.int32())), pa.array(decoded, pa.string())]


def _digest(codec: Codec, ids: np.ndarray, size: np.ndarray, decoded: list[str]) -> list[pa.Array]:
    upto = np.concatenate(([0], np.cumsum(codec.decimal_size[ids])))[np.concatenate(([0], np.cumsum(size)))].tolist()
    line = codec.joined(ids).tobytes()
    shas = [hashlib.sha256(line[a : max(a, b - 1)]).hexdigest() for a, b in zip(upto[:-1], upto[1:], strict=True)]
    return [pa.array(size), pa.array(shas, pa.string()), pa.array([_sha(x) for x in decoded], pa.string())]


def _compared(codec: Codec, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], list[bool]]:
    """Ids of all texts back to back, how many of each, decoded texts, and of each text if codec and library agree."""
    want = codec.library.encode(texts, num_threads=1)
    ids, size = codec.encode_all(texts)
    parts = np.split(ids, np.cumsum(size)[:-1])
    agrees = [x.tolist() == y for x, y in zip(parts, want, strict=True)]
    if not all(agrees):
        ids = np.fromiter(chain.from_iterable(want), np.int32)
        size = np.array([len(x) for x in want], np.int64)
    return ids, size, codec.library.decode(want, num_threads=1), agrees


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Parts of a batch of about ``TOGETHER`` characters."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > TOGETHER:
            yield first, i
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, len(texts)


def _run(docs: DataFrame, model: str | None, schema: str, made) -> DataFrame:
    with open(model or default_model(), "rb") as f:
        proto = f.read()
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(proto)
        for batch in batches:
            every = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _slices(every):  # the ids of one slice are in memory at a time
                *found, agrees = _compared(codec, every[a:b])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], *made(codec, *found), pa.array(agrees)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
