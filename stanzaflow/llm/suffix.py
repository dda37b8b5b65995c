"""Suffix-array dedup: bytes covered by a long string that an earlier document has too.

A string of ``WINDOW`` bytes (a window) is repeated if it also starts in a
document with a smaller doc_id. Windows are dealt to shards by an anchor, the
least hash of the ``ANCHOR``-byte strings inside the window, so equal windows
always meet; neighbouring windows with one anchor travel together as a piece
(62 bytes for 13 windows on average).

1. Anchors that only one document has are dropped. Only hashes move, and an
   anchor that many documents of a task share is sent on once. The windows of an
   anchor with over ``SPLIT`` contents (a short common string between ever
   different neighbours) are dealt one by one, by their own hash; those that only
   one document has are dropped likewise.
2. Each task combines its equal pieces: a content goes to its shard once, with
   its first and last document; where it stood stays behind. So a passage of any
   number of documents reaches its shard as often as there are tasks.
3. In a shard, equal contents are combined; where an anchor has several, their
   suffix array is built by induced sorting, its permuted common prefixes tell
   which suffixes share a window, and each run of those gets the first document
   of all its members.
4. The runs go back to the tasks' lists, which turn them into byte ranges.

Whole strings are compared; hashes only decide where they meet.

Defined results: a null text is empty; texts shorter than a window lose nothing;
an empty table gives no rows; rows with a null doc_id lose nothing and remove
nothing; rows that repeat a doc_id are judged each on its own text and remove
nothing from each other; extra columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut_lineage, whole_text

WINDOW = 50
ANCHOR = 24  # few strings of this length stand in two texts by chance
_ROOM = WINDOW - ANCHOR + 1
#: Windows of one piece at most.
_REACH = _ROOM
#: The windows of an anchor with more contents than this (summed over tasks) are dealt one by one.
SPLIT = 4096
#: Bytes of text behind one group of anchors, which may bring some four times its share of pieces.
SHARD = 8 << 20
#: Bytes of contents in one suffix array.
ARRAY = 1 << 18
_STEP, _FLUSH = 1 << 16, 1 << 19
#: With fewer suffixes than this a symbol, array steps do not pay; the same steps go one by one.
_BUCKET = 128
_ODD = 0x9E3779B97F4A7C15
_APART = np.uint64(0x5851F42D4C957F2D)  # hashes of windows are no anchors
_BYTE = np.random.default_rng(16).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)


# -- suffix arrays -----------------------------------------------------------------------------------


def _rising(t: np.ndarray) -> np.ndarray:
    """Of each suffix, whether it is smaller than the next one (S-type); the last symbol is a unique least one."""
    n = len(t)
    up = np.ones(n, bool)
    steps = np.flatnonzero(t[1:] != t[:-1])
    if len(steps):
        ahead = np.repeat(t[steps + 1] > t[steps], np.diff(np.concatenate(([-1], steps))))
        up[: len(ahead)] = ahead
    return up


class _Waves:
    """Induced sorting by array steps. Buckets are scanned in order, each in waves of what has just been put into it."""

    def __init__(self, t: np.ndarray, up: np.ndarray):
        self.t, self.up = t, up
        self.counts = np.bincount(t)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts

    def _put(self, items: np.ndarray, rising: bool) -> None:
        p = items[items > 0] - 1
        p = p[self.up[p] == rising]
        if not len(p):
            return
        c = self.t[p]
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        size = np.diff(np.append(first, len(c)))
        nth = np.arange(len(c)) - np.repeat(first, size)
        if rising:
            self.sa[self.tail[c] - 1 - nth] = p
            self.tail[c[first]] -= size
        else:
            self.sa[self.head[c] + nth] = p
            self.head[c[first]] += size

    def run(self, lms: np.ndarray) -> np.ndarray:
        """lms: leftmost rising suffixes; their order within a bucket is taken over."""
        self.sa = np.full(len(self.t), -1, np.int32)
        self.head, self.tail = self.starts.copy(), self.ends.copy()
        of = self.t[lms]
        lms = lms[np.argsort(of, kind="stable")]
        upto = np.cumsum(np.bincount(of, minlength=len(self.counts)))
        used = np.flatnonzero(self.counts)
        for c in used:
            at = self.starts[c]
            while at < self.head[c]:
                at, wave = self.head[c], self.sa[at : self.head[c]]
                self._put(wave, False)
            self._put(lms[upto[c - 1] if c else 0 : upto[c]], False)
        for c in used[::-1]:
            at = self.ends[c]
            while at > self.tail[c]:
                at, wave = self.tail[c], self.sa[self.tail[c] : at][::-1]
                self._put(wave, True)
            self._put(self.sa[self.starts[c] : self.head[c]][::-1], True)
        self.sa[0] = len(self.t) - 1
        return self.sa


class _Single:
    """Induced sorting, one suffix at a time."""

    def __init__(self, t: np.ndarray, up: np.ndarray):
        counts = np.bincount(t)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        # of each suffix, the bucket of the one that starts before it, if that falls (rises); of no suffix, none
        before, rises = np.append(np.roll(t, 1), -1), np.append(np.roll(up, 1), False)
        before[0] = -1
        self.falling, self.rising = (np.where(x, before, -1).tolist() for x in (~rises, rises))
        self.t = t

    def run(self, lms: np.ndarray) -> np.ndarray:
        n, falling, rising = len(self.t), self.falling, self.rising
        sa = np.full(n, n, np.int64)
        of = self.t[lms]
        order = np.argsort(of, kind="stable")
        of = of[order]
        nth = np.arange(len(of)) - np.searchsorted(of, of)
        sa[self.ends[of] - np.bincount(of, minlength=len(self.ends))[of] + nth] = lms[order]
        sa = sa.tolist()
        head, tail = self.starts.tolist(), self.ends.tolist()
        for i in sa:  # it grows ahead of where it is read
            c = falling[i]
            if c >= 0:
                at = head[c]
                sa[at] = i - 1
                head[c] = at + 1
        for i in reversed(sa):
            c = rising[i]
            if c >= 0:
                tail[c] = at = tail[c] - 1
                sa[at] = i - 1
        sa[0] = n - 1
        return np.array(sa, np.int32)


def _named(t: np.ndarray, order: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names of the sorted leftmost rising substrings: equal strings, equal names; in ``order``."""
    size = np.zeros(len(t), np.int64)
    size[lms[:-1]] = np.diff(lms)
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        differ = t[a[left] + k] != t[b[left] + k]
        same[left[differ]] = False
        k += 1
        left = left[~differ]
        left = left[size[a[left]] >= k]
    return np.cumsum(np.concatenate(([False], ~same)))


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``t``: small non-negative integers, the last one less than all others.

    The leftmost rising substrings are sorted by induction and named, the string
    of names is sorted recursively, and its order induces that of all suffixes.
    """
    if len(t) < 3:
        return np.arange(len(t))[::-1].copy()
    up = _rising(t)
    is_lms = np.zeros(len(t), bool)
    is_lms[1:] = up[1:] & ~up[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    induction = (_Waves if len(t) >= _BUCKET * int(t.max()) else _Single)(t, up)
    order = induction.run(lms)
    order = order[is_lms[order]]
    names = _named(t, order, lms)
    if names[-1] < len(lms) - 1:
        place = np.empty(len(t), np.int64)
        place[order] = names
        order = lms[suffix_array(place[lms])]
    return induction.run(order)


def common_prefixes(t: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Permuted common prefixes: for each position, of its suffix and the one before it in ``sa``, up to ``cap`` symbols.

    Four symbols are compared at a time.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    padded = np.zeros(n + cap + 4, np.uint16)
    padded[:n] = t
    words = np.lib.stride_tricks.sliding_window_view(padded, 4)
    out = np.zeros(n, np.int32)
    left = np.flatnonzero(before >= 0)
    for k in range(0, cap, 4):
        a = np.ascontiguousarray(words[left + k]).view("<u8")[:, 0]
        b = np.ascontiguousarray(words[before[left] + k]).view("<u8")[:, 0]
        x = a ^ b
        same = x == 0
        low = x[~same]
        low &= ~low + np.uint64(1)
        out[left[~same]] += (np.frexp(low.astype(np.float64))[1] - 1) // 16
        left = left[same]
        out[left] += 4
        if not len(left):
            break
    return np.minimum(out, np.minimum(cap, n - np.arange(n)))


# -- anchors and pieces ------------------------------------------------------------------------------


def _power(e: int) -> np.uint64:
    return np.uint64(pow(_ODD, e, 1 << 64))


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Of each string of ``width`` bytes, a hash."""
    h, done, powers = _BYTE[data], 1, []
    while 2 * done <= width:
        powers.append((done, h))
        h = h[:-done] * _power(done) + h[done:]
        done *= 2
    for part, x in reversed(powers):
        if done + part <= width:
            h = h[: len(x) - done] * _power(part) + x[done : done + len(h)]
            done += part
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def _anchors(h: np.ndarray) -> np.ndarray:
    """h: hashes of strings of ``ANCHOR`` bytes. For each window, its anchor."""
    width = 1
    while 2 * width <= _ROOM:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (_ROOM - width)], h[_ROOM - width :]) if width < _ROOM else h


def pieces(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """data: texts back to back, ``ends`` their ends. Starts, numbers of windows, anchors and signatures of all pieces.

    Equal pieces have equal signatures, others rarely.
    """
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = _hashes(data, ANCHOR)
    m = _anchors(h)
    inside = np.ones(len(data) + WINDOW, bool)
    for d in range(1, WINDOW):  # the last windows of a text would cross its end
        inside[np.maximum(ends - d, 0)] = False
    inside = inside[: len(m)]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(m)))
    start, count = start[inside[start]], count[inside[start]]
    parts = -(-count // _REACH)
    if len(parts) and parts.max() > 1:
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + nth * _REACH
        count = np.minimum(np.repeat(count, parts) - nth * _REACH, _REACH)
    signature = (h[start] * _power(3) ^ h[start + count + (WINDOW - 1 - ANCHOR)]) + count.astype(np.uint64)
    return start, count, m[start], signature


def _singly(data: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of some pieces: the piece, the start and the hash of each."""
    piece = np.repeat(np.arange(len(start)), count)
    at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(len(piece))
    return piece, at, _hashes(data, WINDOW)[at] ^ _APART


def _blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in blocks of some ``_STEP`` bytes: data, ends, and of each segment its text and its offset in it.

    A long text is cut into segments that overlap by less than a window, so that each window is in one.
    """
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - WINDOW + 1, 0), _STEP):
            part = text[at : at + _STEP + WINDOW - 1]
            held.append((part, i, at))
            size += len(part)
            if size >= _STEP:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(part for part, _, _ in held), np.uint8)
    return data, np.cumsum([len(x[0]) for x in held]), np.array([x[1] for x in held]), np.array([x[2] for x in held])


def _binary(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _key(m: np.ndarray, shards: int) -> np.ndarray:
    """What is kept of an anchor: its upper half and its shard.

    A shard has about a million anchors at every size, so these let few of them
    meet another by chance; their contents then differ.
    """
    return m >> np.uint64(32) << np.uint64(32) | m % np.uint64(shards)


#: Packed columns of an entry. Documents come in planes of 16 bits, of which most are alike.
_KEY = {"upper": np.uint32, "home": np.uint32}
_MET = _KEY | {f"doc{i}": np.uint16 for i in range(4)} | {"says": np.uint32}
_SENT = _KEY | {f"{x}{i}": np.uint16 for x in ("first", "last") for i in range(4)} | {"nth": np.uint32, "size": np.uint16}
_HOT = np.uint64(1 << 31)


def _pack(shard: np.ndarray, kinds: dict, key: np.ndarray, docs: dict, **more: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
    """Entries sorted by shard: their order, the numbers of entries of each row, and the row's columns."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    at = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    n = np.diff(np.append(at, len(shard)))
    values = {"upper": key[order] >> np.uint64(32), "home": key[order]} | {k: v[order] for k, v in more.items()}
    for name, doc in docs.items():
        planes = doc[order].view(np.uint16).reshape(-1, 4)
        values |= {f"{name}{i}": planes[:, i] for i in range(4)}
    columns = {"shard": pa.array(shard[at].astype(np.int32))}
    for k, kind in kinds.items():
        c = values[k].astype(kind)
        columns[k] = _binary(n * c.itemsize, c.view(np.uint8))
    return order, n, columns


def _unpack(table: pa.Table, kinds: dict, docs: tuple[str, ...]) -> dict:
    x = {k: np.frombuffer(b"".join(table.column(k).to_pylist()), kind) for k, kind in kinds.items()}
    x["key"] = x.pop("upper").astype(np.uint64) << np.uint64(32) | x.pop("home")
    for name in docs:
        x[name] = np.column_stack([x.pop(f"{name}{i}") for i in range(4)]).view(np.int64)[:, 0]
    return x


def _schema(kinds: dict) -> str:
    return "shard int, " + ", ".join(f"{k} binary" for k in kinds)


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each combination once, ordered by the last column, then the one before it, and so on."""
    order = np.lexsort(columns)
    columns = tuple(c[order] for c in columns)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return tuple(c[new] for c in columns)


def _met(shards: int, windows: bool):
    """What a task has to say about its anchors, packed by shard; or, of given anchors, about their windows."""

    def packed(keys: list, docs: list, signatures: list) -> pa.RecordBatch:
        every, doc, signature = _key(np.concatenate(keys), shards), np.concatenate(docs), np.concatenate(signatures)
        contents = np.unique(_distinct(signature, every)[1], return_counts=True)[1]
        doc, key = _distinct(doc, every)
        first = np.concatenate(([True], key[1:] != key[:-1]))
        n = np.diff(np.append(np.flatnonzero(first), len(key)))
        # the first document speaks for all n; the others (0) are known to share the anchor and go anywhere
        shard = np.where(first, (key & np.uint64(0xFFFFFFFF)).astype(np.int64), doc % shards)
        says = np.zeros(len(key), np.int64)
        says[first] = 2 * contents + (n > 1)
        return pa.RecordBatch.from_pydict(_pack(shard, _MET, key, {"doc": doc}, says=says)[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        n = 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            hot = np.unique(batch.column("anchors").flatten().to_numpy(zero_copy_only=False).view(np.uint64)) if windows else None
            for data, ends, owner, _ in _blocks(batch.column("text").to_pylist()):
                start, count, key, signature = pieces(data, ends)
                doc = ids[owner[np.searchsorted(ends, start, "right")]]
                if windows:
                    keep = np.isin(_key(key, shards), hot)
                    of, _, key = _singly(data, start[keep], count[keep])
                    doc, signature = doc[keep][of], key
                for x, y in zip(held, (key, doc, signature), strict=True):
                    x.append(y)
                n += len(key)
                if n >= _FLUSH:
                    yield packed(*held)
                    held, n = ([], [], []), 0
        if n:
            yield packed(*held)

    return run


def _shared(split: int):
    """Of one shard: each document and anchor that another document has too, and whether the anchor has over ``split`` contents."""

    def run(table: pa.Table) -> pa.Table:
        x = _unpack(table, _MET, ("doc",))
        order = np.argsort(x["key"], kind="stable")
        key, doc, said = (x[k][order] for k in ("key", "doc", "says"))
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.diff(np.append(at, len(key)))
        several = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
        keep = (said == 0) | (said & 1 == 1) | np.repeat(several, n)
        hot = np.repeat(np.add.reduceat((said >> 1).astype(np.int64), at) > split, n)
        return pa.table({"doc_id": pa.array(doc[keep]), "anchor": pa.array(key[keep].view(np.int64)), "hot": pa.array(hot[keep])})

    return run


_CONTENTS = {"shard": pa.int32()} | {k: pa.binary() for k in [*_SENT, "data"]}
_PLACES = {k: pa.binary() for k in ("code", "doc", "mark", "at")}
_PIECES = {"flush": pa.int64()} | _CONTENTS | _PLACES


def _combined(data: np.ndarray, size: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Equal strings: of each string its number; the strings; of each, where it stands first, and its first and last document."""
    coded = _binary(size, data).dictionary_encode()
    code = coded.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    at = np.flatnonzero(np.concatenate(([True], np.diff(code[order]) != 0)))
    return code, coded.dictionary, order[at], np.minimum.reduceat(first[order], at), np.maximum.reduceat(last[order], at)


def _cut_out(shards: int):
    """Pieces under shared anchors, equal ones combined: contents packed by shard, and in a row of its own where each stood.

    An anchor that one document of the batch shares, all that have it share.
    """

    def row(columns: dict, flush: int) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        columns["flush"] = pa.array([flush] * n, pa.int64())
        return pa.RecordBatch.from_arrays([columns.get(k, pa.nulls(n, t)) for k, t in _PIECES.items()], names=list(_PIECES))

    def packed(held: list, flush: int) -> Iterator[pa.RecordBatch]:
        key, doc, mark, at, size = (np.concatenate([h[i] for h in held]) for i in range(5))
        code, contents, one, first, last = _combined(np.concatenate([h[5] for h in held]), size, doc, doc)
        press = zstandard.ZstdCompressor(level=1).compress
        places = (code.astype(np.int32), doc, mark, at.astype(np.uint32))
        yield row({k: pa.array([press(v.tobytes())], pa.binary()) for k, v in zip(_PLACES, places, strict=True)}, flush)
        shard = (key[one] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order, n, columns = _pack(shard, _SENT, key[one], {"first": first, "last": last}, nth=np.arange(len(one)), size=size[one])
        text = contents.take(pa.array(order))
        text, upto = b"".join(text.to_pylist()), [0, *np.cumsum(size[one][order])[np.cumsum(n) - 1].tolist()]
        columns["data"] = pa.array([press(text[a:b]) for a, b in zip(upto[:-1], upto[1:], strict=True)], pa.binary())
        yield row(columns, flush)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, flush = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            told = np.unique(batch.column("anchors").flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            wanted, hot = told & ~_HOT, (told & _HOT) != 0
            order = np.argsort(wanted, kind="stable")
            wanted, hot = wanted[order], hot[order]
            known = lambda key: wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
            ids, marks = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy()
            for data, ends, owner, offset in _blocks(batch.column("text").to_pylist()):
                start, count, key, _ = pieces(data, ends)
                key = _key(key, shards)
                keep = known(key)
                start, count, key = start[keep], count[keep], key[keep]
                if len(key) and (apart := hot[np.searchsorted(wanted, key)]).any():
                    _, at, single = _singly(data, start[apart], count[apart])
                    single = _key(single, shards)
                    at, single = at[keep := known(single)], single[keep]
                    start, key = np.concatenate((start[~apart], at)), np.concatenate((key[~apart], single))
                    count = np.concatenate((count[~apart], np.ones(len(at), np.int64)))
                segment = np.searchsorted(ends, start, "right")
                line = owner[segment]
                at = start - np.concatenate(([0], ends))[segment] + offset[segment]
                size = count + WINDOW - 1
                took = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
                held.append((key, ids[line], marks[line], at, size, data[took]))
                n += len(start)
                if n >= _FLUSH // 2:
                    yield from packed(held, flush)
                    held, n, flush = [], 0, flush + 1
        if n:
            yield from packed(held, flush)

    return run


def _array_runs(contents: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows in some contents: content, first window, end, and the first document that has these windows."""
    texts = contents.to_pylist()
    size = np.array([len(x) for x in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    # symbols: 0 ends the array, 1 a content, 2 to 257 are bytes
    begin = np.cumsum(size + 1) - size - 1
    t = np.ones(len(data) + len(size) + 1, np.int16)
    t[-1] = 0
    t[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(len(data))] = data.astype(np.int16) + 2
    sa = suffix_array(t)
    shared = common_prefixes(t, sa, WINDOW) >= WINDOW
    owner = np.repeat(np.arange(len(size)), size + 1)
    room = np.zeros(len(t), bool)  # where a whole window starts
    room[:-1] = np.arange(len(t) - 1) <= np.repeat(begin + size - WINDOW, size + 1)
    sa = sa[room[sa]]
    # a window's neighbour with the same bytes is a window too, so runs survive leaving out the rest
    fresh = np.flatnonzero(np.concatenate(([True], ~shared[sa[1:]])))
    least = np.minimum.reduceat(first[owner[sa]], fresh)
    known = np.zeros(len(t), np.int64)
    known[sa] = np.repeat(least, np.diff(np.append(fresh, len(sa))))
    at = np.flatnonzero(room)
    own = owner[at]
    runs = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (known[at[1:]] != known[at[:-1]]))))
    a = at[runs] - begin[own[runs]]
    return own[runs], a, a + np.diff(np.append(runs, len(at))), known[at[runs]]


_ANSWER = {"nth": np.uint32, "a": np.uint16, "b": np.uint16, "first": np.int64}


def _in_shard(array: int):
    """Of one shard: for each task's contents, the runs of windows that a document before the task's last one has.

    A suffix array takes about ``array`` bytes.
    """

    def run(table: pa.Table) -> pa.Table:
        x = _unpack(table, _SENT, ("first", "last"))
        flush = np.repeat(table.column("flush").to_numpy(), [len(v) // 2 for v in table.column("size").to_pylist()])
        unpress = zstandard.ZstdDecompressor().decompress
        data = np.frombuffer(b"".join(map(unpress, table.column("data").to_pylist())), np.uint8)
        code, contents, one, first, last = _combined(data, x["size"].astype(np.int64), x["first"], x["last"])
        key, size = x["key"][one], x["size"][one].astype(np.int64)
        by_key = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.concatenate(([True], key[by_key[1:]] != key[by_key[:-1]])))
        several = np.repeat(np.diff(np.append(at, len(key))) > 1, np.diff(np.append(at, len(key))))
        alone = by_key[~several]
        runs = [(alone, np.zeros(len(alone), np.int64), size[alone] - (WINDOW - 1), first[alone])]
        mixed = by_key[several]
        # arrays of about ``array`` bytes; the contents of an anchor stay together
        part = np.cumsum(size[mixed]) // array
        fresh = np.concatenate(([True], key[mixed[1:]] != key[mixed[:-1]])) if len(mixed) else np.zeros(0, bool)
        part = np.maximum.accumulate(np.where(fresh, part, 0)) if len(mixed) else part
        for members in np.split(mixed, np.flatnonzero(np.diff(part)) + 1) if len(mixed) else []:
            own, a, b, told = _array_runs(contents.take(pa.array(members)), first[members])
            runs.append((members[own], a, b, told))
        own, a, b, told = (np.concatenate([r[i] for r in runs]) for i in range(4))
        keep = np.flatnonzero(told < last[own])
        keep = keep[np.argsort(own[keep], kind="stable")]
        own, a, b, told = own[keep], a[keep], b[keep], told[keep]
        n = np.bincount(own, minlength=len(size))
        begin = np.cumsum(n) - n
        row = np.repeat(np.arange(len(code)), n[code])
        nth = np.repeat(begin[code] - np.cumsum(n[code]) + n[code], n[code]) + np.arange(len(row))
        hit = told[nth] < x["last"][row]
        row, nth = row[hit], nth[hit]
        order = np.argsort(flush[row], kind="stable")
        row, nth = row[order], nth[order]
        at = np.flatnonzero(np.concatenate(([True], np.diff(flush[row]) != 0))) if len(row) else np.zeros(0, np.int64)
        n = np.diff(np.append(at, len(row)))
        values = {"nth": x["nth"][row], "a": a[nth], "b": b[nth], "first": told[nth]}
        columns = {k: _binary(n * np.dtype(t).itemsize, values[k].astype(t).view(np.uint8)) for k, t in _ANSWER.items()}
        return pa.table({"flush": pa.array(flush[row][at], pa.int64())} | columns)

    return run


def _spans(places: pa.Table, answers: pa.Table) -> pa.Table:
    """Of one task's list and the runs of its contents: byte ranges to remove, merged, a row for each document."""
    if not len(places) or not len(answers):
        return pa.table({"doc_id": pa.array([], pa.int64()), "mark": pa.array([], pa.int64()), "start": pa.array([], pa.binary()), "end": pa.array([], pa.binary())})
    unpress = zstandard.ZstdDecompressor().decompress
    kinds = (np.int32, np.int64, np.int64, np.uint32)
    code, doc, mark, at = (np.frombuffer(unpress(places.column(k)[0].as_py()), t) for k, t in zip(_PLACES, kinds, strict=True))
    x = {k: np.frombuffer(b"".join(answers.column(k).to_pylist()), t) for k, t in _ANSWER.items()}
    order = np.argsort(x["nth"], kind="stable")
    n = np.bincount(x["nth"], minlength=code.max() + 1)
    begin = np.cumsum(n) - n
    row = np.repeat(np.arange(len(code)), n[code])
    run = order[np.repeat(begin[code] - np.cumsum(n[code]) + n[code], n[code]) + np.arange(len(row))]
    hit = x["first"][run] < doc[row]
    row, run = row[hit], run[hit]
    start = at[row].astype(np.int64) + x["a"][run]
    end = at[row].astype(np.int64) + x["b"][run] + (WINDOW - 1)
    doc, mark = doc[row], mark[row]
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = doc[order], mark[order], start[order], end[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    # ends of one document never reach into the next one's numbers
    far = int(end.max(initial=0)) + 1
    lane = np.cumsum(fresh) * far
    upto = np.maximum.accumulate(end + lane)
    new = np.ones(len(doc), bool)
    new[1:] = (start + lane)[1:] > upto[:-1]
    at = np.flatnonzero(new)
    left, right = start[at], (upto - lane)[np.append(at[1:], len(doc)) - 1] if len(at) else end
    lead = np.flatnonzero(fresh[at])
    n = np.diff(np.append(lead, len(at))) * 8
    return pa.table(
        {"doc_id": pa.array(doc[at][lead]), "mark": pa.array(mark[at][lead]), "start": _binary(n, left.view(np.uint8)), "end": _binary(n, right.view(np.uint8))}
    )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            kept, done, removed, runs = hashlib.sha256(), 0, 0, 0
            start, end = (np.frombuffer(b"".join(s[k] for s in spans or ()), np.int64) for k in ("start", "end"))
            order = np.argsort(start, kind="stable")
            for a, b in zip(start[order].tolist(), end[order].tolist(), strict=True):
                if a > done or not runs:
                    runs += 1
                    kept.update(text[done:a])
                    done = a
                removed += max(0, b - done)
                done = max(done, b)
            kept.update(text[done:])
            rows.append((len(text), removed, runs, kept.hexdigest()))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _typed(columns: dict) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{k} {names[t]}" for k, t in columns.items())


def _wanted(rows: DataFrame, scratch: Scratch, shards: int) -> DataFrame:
    """doc_id, anchors: those that another document has too, the split ones flagged, and the windows of these.

    A document's list is bounded by its own text: 8 bytes an anchor, of which there is one for 13 bytes of text on average
    (one a byte where anchors are split).
    """
    shared = "doc_id long, anchor long, hot boolean"
    pairs = scratch.save(rows.mapInArrow(_met(shards, False), _schema(_MET)).groupBy("shard").applyInArrow(_shared(SPLIT), shared), "anchors")
    hot = cut_lineage(pairs.where("hot").select("anchor").distinct())
    if hot.isEmpty():
        return pairs.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    marked = pairs.join(hot.withColumn("split", F.lit(True)), "anchor", "left")
    split = scratch.save(marked.where("split").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors")), "split")
    met = rows.join(split, "doc_id").mapInArrow(_met(shards, True), _schema(_MET))
    windows = scratch.save(met.groupBy("shard").applyInArrow(_shared(SPLIT), shared), "windows")
    told = F.when(F.col("split"), F.col("anchor").bitwiseOR(F.lit(_HOT.item()))).otherwise(F.col("anchor"))
    every = marked.select("doc_id", told.alias("anchor")).unionByName(windows.select("doc_id", "anchor"))
    return every.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns doc_id, mark (hash of the text), start, end (packed): byte ranges to remove, some rows a document."""
    rows = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    found = rows.withColumn("mark", F.xxhash64("text")).join(_wanted(rows, scratch, shards), "doc_id")
    cut = scratch.save(found.select("doc_id", "mark", "text", "anchors").mapInArrow(_cut_out(shards), _typed(_PIECES)), "pieces")
    for name in ("anchors", "split", "windows"):
        scratch.drop(name)
    sent = cut.where("shard is not null").select("flush", *_CONTENTS)
    answers = sent.groupBy("shard").applyInArrow(_in_shard(ARRAY), "flush long, " + ", ".join(f"{k} binary" for k in _ANSWER))
    places = cut.where("shard is null").select("flush", *_PLACES)
    return places.groupBy("flush").cogroup(answers.groupBy("flush")).applyInArrow(_spans, "doc_id long, mark long, start binary, end binary")


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    scratch = Scratch(docs.sparkSession)
    spans = repeated_spans(docs, scratch).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = cut_lineage(spans)
    scratch.drop()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text")).join(spans, ["doc_id", "mark"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
