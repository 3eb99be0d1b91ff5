"""Exact batch tokenisation with a cache of white-space-led chunks.

A byte-level BPE tokeniser cuts a text into pieces before it merges bytes, and no piece crosses a single space or line
feed that stands between two visible characters. So the ids of a text are those of its chunks " word" one after
another, and the tokenizers library has to see each distinct chunk once. Chunks are found, keyed and looked up by numpy
on the Arrow bytes; a key is the chunk's own bytes, so a hit is exact. Texts with other white space (runs, tabs,
no-break spaces) go to the library whole, and so do texts that hold the literal of an added token, such as a special one,
which the library gives the token's own id.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from .common import text_bytes

#: Distinct chunks kept at a time; the cache is emptied beyond it, which bounds a worker's memory to some 100 MB.
CACHE_CHUNKS = 1_000_000
#: Longest chunk that is cached, in bytes (a multiple of 8).
KEY_BYTES = 32
#: Bytes of text handled at once (a longer single text is handled alone).
SLICE_BYTES = 1 << 20
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 10]] = True
_ODD = np.zeros(256, bool)
_ODD[[0, 9, 11, 12, 13, 28, 29, 30, 31]] = True


class BatchEncoder:
    """Ids of many texts at once. One for each Python worker (see ``encoder``)."""

    #: Whether a text's first chunk is encoded unlike the same chunk elsewhere.
    prefixed = False
    #: UTF-8 literals that the library looks for before anything else.
    added: list[bytes] = []

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.limit = cache_chunks
        self._clear()

    def _clear(self) -> None:
        self.bits = max(10, int(np.ceil(np.log2(self.limit / 0.6))))
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((KEY_BYTES // 8, 1 << 14), np.uint64)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int32)
        self.ids = np.zeros(1 << 16, self.dtype)
        self.n = self.used = 0

    def direct(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after another, number of ids of each)."""
        got = self.direct(chunks)
        lens = np.fromiter(map(len, got), np.int32, len(got))
        return np.fromiter((i for x in got for i in x), self.dtype, int(lens.sum())), lens

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        h = keys[0] * _MULT[0]
        for k, m in zip(keys[1:], _MULT[1:]):
            h ^= (k ^ (h >> np.uint64(29))) * m
        return ((h ^ (h >> np.uint64(32))) * _MULT[1] >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where there is none."""
        at, out = self._hash(keys), np.full(keys.shape[1], -1, np.int32)
        open_ = np.arange(keys.shape[1])
        mask = len(self.slot) - 1
        while len(open_):
            e = self.slot[at[open_]]
            open_, e = open_[e >= 0], e[e >= 0]
            same = np.ones(len(open_), bool)
            for k, own in zip(keys, self.keys):
                same &= k[open_] == own[e]
            out[open_[same]] = e[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & mask
        return out

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """Adds distinct new chunks."""
        n, m = self.n, len(texts)
        while n + m > len(self.starts):
            self.starts, self.lens = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens))
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)], axis=1)
        self.keys[:, n : n + m] = keys
        for at in range(0, m, 8192):
            flat, lens = self.chunk_ids(texts[at : at + 8192])
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(flat)] = flat
            self.starts[n + at : n + at + len(lens)] = self.used + np.cumsum(lens) - lens
            self.lens[n + at : n + at + len(lens)] = lens
            self.used += len(flat)
        self.n += m
        if self.n > 0.7 * len(self.slot):  # one long text may bring more chunks than the cache is made for
            self.bits = int(np.ceil(np.log2(self.n / 0.5)))
            self.slot = np.full(1 << self.bits, -1, np.int32)
            self._insert(self.keys[:, : self.n], 0)
        else:
            self._insert(keys, n)

    def _insert(self, keys: np.ndarray, first: int) -> None:
        at, mask, left = self._hash(keys), len(self.slot) - 1, np.arange(keys.shape[1])
        while len(left):
            free = left[self.slot[at[left]] < 0]
            self.slot[at[free]] = first + free
            won = free[self.slot[at[free]] == first + free]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & mask

    def _slice(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = int(starts[0]), int(starts[-1] + lens[-1])
        buf = np.zeros(hi - lo + KEY_BYTES + 8, np.uint8)
        buf[: hi - lo] = data[lo:hi]
        b, starts = buf[: hi - lo], starts - lo
        ends = starts + lens
        full = np.flatnonzero(lens)
        space = _SPACE[b]
        bad = np.flatnonzero(_ODD[b])
        pair = np.flatnonzero(space[:-1] & space[1:])  # may lie across two texts, which only costs time
        lead = np.flatnonzero((b == 0xC2) | (b == 0xE1) | (b == 0xE2) | (b == 0xE3))
        two = buf[lead + 1]
        three = buf[lead + 2]
        first = b[lead]
        wide = lead[((first == 0xC2) & ((two == 0x85) | (two == 0xA0))) | ((first == 0xE1) & (two == 0x9A)) | ((first == 0xE2) & (((two == 0x80) & ((three < 0x8B) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))) | ((two == 0x81) & (three == 0x9F)))) | ((first == 0xE3) & (two == 0x80) & (three == 0x80))]
        raw = b.tobytes() if self.added else b""
        marks = np.array([m.start() for x in self.added for m in re.finditer(re.escape(x), raw)], np.int64)
        where = np.concatenate([bad, pair, wide, marks])
        odd = np.zeros(len(starts), bool)
        if self.prefixed and len(full):
            odd[full] = space[starts[full]]
        if len(where) and len(full):
            odd[full[np.searchsorted(starts[full], where, "right") - 1]] = True
        head = space
        head[starts[full]] = True
        begin = np.flatnonzero(head)
        size = np.diff(np.append(begin, hi - lo))
        owner = full[np.searchsorted(starts[full], begin, "right") - 1] if len(full) else begin
        size = np.minimum(size, ends[owner] - begin)
        keep = ~odd[owner] & (size > 0)
        if not keep.all():
            begin, size, owner = begin[keep], size[keep], owner[keep]
        words = np.ndarray((len(buf) - 7,), np.dtype("<u8"), buf, 0, (1,))
        keys = np.stack([words[begin + 8 * k] & _MASKS[np.clip(size - 8 * k, 0, 8)] for k in range(KEY_BYTES // 8)])
        long = size > KEY_BYTES
        if long.any():
            keys[:, long] = 0
        if self.n > self.limit:
            self._clear()
        entry = self._find(keys)
        if len(new := np.flatnonzero((entry < 0) & ~long)):
            k = keys[:, new]
            order = np.lexsort(k)
            first = np.ones(len(order), bool)
            first[1:] = (k[:, order[1:]] != k[:, order[:-1]]).any(axis=0)
            pick = new[order[first]]
            raw = b.tobytes()
            self._learn(keys[:, pick], [raw[i : i + s].decode() for i, s in zip(begin[pick].tolist(), size[pick].tolist())])
            entry[new] = self._find(k)
        n_ids = np.where(long, 0, self.lens[entry]).astype(np.int64)
        store, src = self.ids, self.starts[entry]
        if long.any():
            raw, at = b.tobytes(), np.flatnonzero(long)
            texts = [raw[i : i + s].decode() for i, s in zip(begin[at].tolist(), size[at].tolist())]
            got, n_ids[at] = self.chunk_ids(texts)
            src[at] = len(self.ids) + np.cumsum(n_ids[at]) - n_ids[at]
            store = np.concatenate([self.ids, got])
        ends_ = np.cumsum(n_ids)
        flat = store[np.arange(ends_[-1] if len(ends_) else 0) + np.repeat(src - (ends_ - n_ids), n_ids)]
        sizes = np.bincount(owner, n_ids, len(starts)).astype(np.int64)
        if not odd.any():
            return flat, sizes
        raw, at, parts, done = b.tobytes(), np.flatnonzero(odd), [], 0
        where = np.cumsum(sizes) - sizes
        for i, ids in zip(at, self.direct([raw[starts[i] : ends[i]].decode() for i in at])):
            parts += [flat[done : where[i]], np.array(ids, self.dtype)]
            done, sizes[i] = where[i], len(ids)
        return np.concatenate([*parts, flat[done:]]), sizes

    def encode_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, number of ids of each row). A null text has none."""
        data, starts, lens = text_bytes(col)
        parts, sizes, at = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)], 0
        total = np.cumsum(lens)
        while at < len(lens):
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + SLICE_BYTES, "right")))
            if total[to - 1] == base:
                flat, n = np.zeros(0, self.dtype), np.zeros(to - at, np.int64)
            else:
                flat, n = self._slice(data, starts[at:to], lens[at:to])
            parts.append(flat)
            sizes.append(n)
            at = to
        return np.concatenate(parts), np.concatenate(sizes)


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """The encoder of this Python process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
