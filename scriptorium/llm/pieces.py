"""Operator 3: SentencePiece encoding and decoding by batched numpy Viterbi.

The best segmentation maximises the sum of the piece scores in the model file; a character that no piece covers costs
UNKNOWN below the least score and becomes its UTF-8 bytes. A piece never reaches from a visible character into a space,
so a text's words are segmented one by one and each distinct word once (see ``tokens.BatchEncoder``). All words of a
length advance together: at each place, hashes of the substrings that end there are probed in the sorted piece keys, and
the maximum over them is kept with its backpointer. Ties go to the longer last piece.

This is the unigram criterion. Where a model file was made for pair merging, its scores are merge ranks: the result is the
segmentation with the least sum of ranks and may differ from the merges.

The model file's settings are read and must be those that this segmentation keeps to: identity normalisation, a leading
space, spaces kept as they are, byte pieces for unknown characters, no user-defined pieces. Other models raise ValueError.

Defined results: a null text counts as empty and has no pieces; a space and U+2581 are the same character; decoding
returns the text itself otherwise; repeated rows get equal results; an empty table gives no rows; other columns are not
read, whatever their names; a text of any length is segmented whole.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, trim
from .tokens import CACHE_CHUNKS, BatchEncoder

SPACE = "▁"
UNKNOWN = 10.0
_BASE = np.uint64(0x100000001B3)
NORMAL, USER_DEFINED, BYTE = 1, 4, 6


def _fields(raw: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        shift = out = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value = raw[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            value = raw[at : at + n]
            at += n
        yield key >> 3, value


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id."""
    out = []
    with open(path, "rb") as f:
        raw = f.read()
    for number, value in _fields(raw):
        if number == 1:
            own = dict(_fields(value))
            out.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, 1)))
    return out


def check_settings(path: str) -> None:
    """Raises ValueError where the model's settings ask for another treatment of texts. Field numbers are those of the public
    model format; a field that is left out has its default."""
    with open(path, "rb") as f:
        parts = dict(x for x in _fields(f.read()) if x[0] in (2, 3))
    trainer, normalizer = dict(_fields(parts.get(2, b""))), dict(_fields(parts.get(3, b"")))
    wrong = {
        "a normalisation table": bool(normalizer.get(2)),
        "no leading space": not normalizer.get(3, 1),
        "removal of extra spaces": bool(normalizer.get(4, 1)),
        "unescaped spaces": not normalizer.get(5, 1),
        "spaces as suffixes": bool(trainer.get(24, 0)),
        "no byte pieces": not trainer.get(35, 0),
    }
    if any(wrong.values()):
        raise ValueError("the model asks for " + ", ".join(k for k, v in wrong.items() if v))


class PieceEncoder(BatchEncoder):
    """Ids of many texts at once; chunks " word" are cached."""

    prefixed = True

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        check_settings(path)
        pieces = read_model(path)
        if any(t == USER_DEFINED for _, _, t in pieces):
            raise ValueError("the model has user-defined pieces")
        self.dtype = np.uint16 if len(pieces) <= 1 << 16 else np.uint32
        self.limit = cache_chunks
        normal = [(p, s, i) for i, (p, s, t) in enumerate(pieces) if t == NORMAL and p]
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in normal):
            raise ValueError("a piece reaches over a space: words can't be segmented one by one")
        self.longest = max(len(p) for p, _, _ in normal)
        self.bytes = np.zeros(256, self.dtype)
        for i, (p, _, t) in enumerate(pieces):
            if t == BYTE:
                self.bytes[int(p[3:5], 16)] = i
        self.unknown = min(s for _, s, _ in normal) - UNKNOWN
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, _BASE)]), dtype=np.uint64)
        keys = np.array([self._hash_of(p) for p, _, _ in normal], np.uint64)
        order = np.argsort(keys)
        self.piece_keys = keys[order]
        self.piece_score = np.array([s for _, s, _ in normal], np.float64)[order]
        self.piece_id = np.array([i for _, _, i in normal], np.int32)[order]
        self.piece_len = np.array([len(p) for p, _, _ in normal], np.int32)[order]
        if (self.piece_keys[1:] == self.piece_keys[:-1]).any():
            raise ValueError("piece keys collide")
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.piece_keys >> np.uint64(44)).astype(np.int64)] = True
        # decoding: bytes of each piece, one after another
        own = [bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(SPACE, " ").encode() if t == NORMAL else b"" for p, _, t in pieces]
        self.out_len = np.array([len(b) for b in own], np.int64)
        self.out_at = np.cumsum(self.out_len) - self.out_len
        self.out_bytes = np.frombuffer(b"".join(own), np.uint8)
        self._clear()

    def _hash_of(self, piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * _BASE + np.uint64(ord(c) + 1)
        return int(self._spread(h)[0])

    @staticmethod
    def _spread(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each); spaces are SPACE here."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(lens) - lens
        steps_word, steps_at, steps_id, steps_point = [], [], [], []
        for n in np.unique(lens):
            if not n:
                continue
            every = np.flatnonzero(lens == n)
            lot = max(1, (1 << 20) // (int(n) * self.longest))
            for lo in range(0, len(every), lot):
                rows = every[lo : lo + lot]
                x = points[first[rows][:, None] + np.arange(n)]
                back, piece = self._advance(x)
                pos = np.full(len(rows), n)
                live = np.arange(len(rows))
                while len(live):
                    p = pos[live]
                    b, i = back[p, live], piece[p, live]
                    steps_word.append(rows[live])
                    steps_at.append(p)
                    steps_id.append(i)
                    steps_point.append(x[live, p - 1])
                    pos[live] = b
                    live = live[b > 0]
        if not steps_word:
            return np.zeros(0, self.dtype), np.zeros(len(words), np.int32)
        word, at, ids, point = (np.concatenate(c) for c in (steps_word, steps_at, steps_id, steps_point))
        order = np.lexsort((at, word))
        word, ids, point = word[order], ids[order], point[order]
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return ids.astype(self.dtype), np.bincount(word, minlength=len(words)).astype(np.int32)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in point[unknown].tolist()]
        size = np.ones(len(ids), np.int64)
        size[unknown] = [len(b) for b in raw]
        flat = np.repeat(ids, size)
        flat[flat < 0] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        return flat.astype(self.dtype), np.bincount(np.repeat(word, size), minlength=len(words)).astype(np.int32)

    def _advance(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backpointers and pieces (-1: unknown) by place, for words of one length."""
        m, n = x.shape
        prefix = np.zeros((n + 1, m), np.uint64)
        for i in range(n):
            prefix[i + 1] = prefix[i] * _BASE + x[:, i] + np.uint64(1)
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0
        back, piece = np.zeros((n + 1, m), np.int64), np.full((n + 1, m), -1, np.int32)
        for i in range(1, n + 1):
            k = min(self.longest, i)
            begin = np.arange(i - k, i)  # the longest first, so that a tie goes to it
            h = self._spread(prefix[i] - prefix[begin] * self.power[i - begin][:, None])
            score, own = np.full((k, m), -np.inf), np.full((k, m), -1, np.int32)
            score[-1] = best[i - 1] + self.unknown
            a, b = np.nonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
            if len(a):
                key = h[a, b]
                at = np.minimum(np.searchsorted(self.piece_keys, key), len(self.piece_keys) - 1)
                hit = (self.piece_keys[at] == key) & (self.piece_len[at] == i - begin[a])
                a, b, at = a[hit], b[hit], at[hit]
                score[a, b] = best[begin[a], b] + self.piece_score[at]
                own[a, b] = self.piece_id[at]
            top = score.argmax(axis=0)
            cols = np.arange(m)
            best[i], back[i], piece[i] = score[top, cols], begin[top], own[top, cols]
        return back, piece

    def chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.words([(c if c[0] in " \n" else SPACE + c).replace(" ", SPACE) for c in chunks])

    def direct(self, texts: list[str]) -> list[list[int]]:
        """Whole texts with any white space."""
        out = []
        for t in texts:
            t = SPACE + t.replace(" ", SPACE)
            words, at = [], 0
            while at < len(t):  # a word: a run of spaces and the visible run after it
                end = at
                while end < len(t) and t[end] == SPACE:
                    end += 1
                nxt = t.find(SPACE, end)
                nxt = len(t) if nxt < 0 else nxt
                words.append(t[at:nxt])
                at = nxt
            known = dict.fromkeys(words)
            flat, lens = self.words(list(known))
            ends = np.cumsum(lens)
            own = {w: flat[e - n : e].tolist() for w, e, n in zip(known, ends.tolist(), lens.tolist())}
            out.append([i for w in words for i in own[w]])
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 bytes of each text."""
        size = self.out_len[ids]
        ends = np.cumsum(size)
        raw = self.out_bytes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.out_at[ids] - (ends - size), size)].tobytes()
        bounds = np.concatenate([[0], np.cumsum(counts)])
        at = np.concatenate([[0], ends])[bounds].tolist()
        return [raw[a + 1 : b] if raw[a : a + 1] == b" " else raw[a:b] for a, b in zip(at, at[1:])]


_ENCODERS: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, digest: bool = False) -> DataFrame:
    """doc_id, ids and text (decoded again); with digest n_pieces, ids_crc32, text_crc32 and round_trip in their place."""
    path = model or default_model()

    def run(batches):
        enc = piece_encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids, counts = enc.encode_column(batch.column(1))
                back = enc.decode(ids, counts)
                ends = np.cumsum(counts)
                if not digest:
                    bounds = np.concatenate([[0], ends]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32))), pa.array(back, pa.binary()).cast(pa.string())], names=["doc_id", "ids", "text"])
                    continue
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
                texts = [(t.as_buffer().to_pybytes() if t.is_valid else b"").replace(SPACE.encode(), b" ") for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts), pa.array(crc, pa.int64()), pa.array([zlib.crc32(b) for b in back], pa.int64()), pa.array([a == b for a, b in zip(texts, back)])],
                    names=["doc_id", "n_pieces", "ids_crc32", "text_crc32", "round_trip"],
                )
        trim()

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, text_crc32 long, round_trip boolean" if digest else "doc_id long, ids array<int>, text string")


def decode_pieces(encoded: DataFrame, *, ids_col: str = "ids", text_col: str = "text", model: str | None = None) -> DataFrame:
    """encoded with the text of its ids; null ids give a null text."""
    path = model or default_model()

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        enc = piece_encoder(path)
        counts = np.array([len(x) if x.is_valid else 0 for x in ids], np.int64)
        raw = enc.decode(np.asarray(ids.flatten(), np.int64), counts)
        return pa.array([b.decode("utf-8", "replace") if x.is_valid else None for b, x in zip(raw, ids)], pa.string())

    return encoded.withColumn(text_col, decode(F.col(ids_col)))


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), digest=True)
