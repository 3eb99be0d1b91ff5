"""The three binary containers of the collection: book packs (.hpk), the encyclopedia (.henc) and word vectors (.svec).

A file is read whole by one task through the engine's file systems, checked against its own counts, and given out a block
at a time. Fixed-width tables are numpy record arrays. Only LZMA sections can be read and written. Writers compress
blocks in parallel and put a file together from the compressed blocks; offsets have 32 bits, so a file is under 4 GB.
"""

from __future__ import annotations

import lzma
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import block_assignment
from ..store import put_file

# Fixed values of the formats.
LZMA = 2
PACK_HEAD = "<4sHBBBBHIIIIIQQ"
PACK_MAGIC, PACK_VERSION = struct.pack("<I", 0x4B504448), 4
PACK_BLOCK = np.dtype([(c, "<u4") for c in ("first_row", "text_at", "text_len", "text_raw", "search_at", "search_len", "search_raw")])
PACK_ROW = np.dtype([("id", "<u4"), ("id_in_book", "<u4"), ("chapter", "<i4"), ("citation_base", "<u4"), ("citation_suffix", "u1"), ("block", "<u2"), ("flags", "u1")])
BOOK_HEAD = "<4sHHIIIII"
BOOK_MAGIC, BOOK_VERSION, PER_BLOCK = b"HENC", 2, 128
BOOK_BLOCK = np.dtype([(c, "<u4") for c in ("first", "at", "size", "raw")])
FULL = "id categories ar_title ar_intro ar_body ar_explanation ar_benefits ar_attribution ar_grade ar_reference en_title en_intro en_body en_explanation en_benefits en_attribution en_grade".split()
LIGHT = "id categories title intro grade attribution".split()
TREE = "id parent en ar direct total".split()
VECTOR_MAGIC = 0x53454D34
LISTS = {"ar_benefits", "en_benefits", "categories"}

PACK_SCHEMA = "slug string, row long, id long, id_in_book long, chapter int, citation string, block int, flags int, arabic string, narrator string, text string, grades string"
CHAPTER_SCHEMA = "slug string, chapter int, first_row long, n_rows long, arabic string, english string, arabic_fold string, english_fold string"


def _need(ok: bool, path: str, what: str) -> None:
    if not ok:
        raise ValueError(f"{path}: {what}")


def _inflate(blob: bytes, raw: int, path: str) -> bytes:
    try:
        out = lzma.decompress(blob)
    except lzma.LZMAError as e:
        raise ValueError(f"{path}: a section is no LZMA data") from e
    _need(len(out) == raw, path, f"a section has {len(out)} bytes instead of {raw}")
    return out


def _string(buf: bytes, at: int) -> tuple[str, int]:
    if at + 4 > len(buf):
        raise ValueError("a string lies beyond its section")
    end = at + 4 + int.from_bytes(buf[at : at + 4], "little")
    if end > len(buf):
        raise ValueError("a string lies beyond its section")
    return buf[at + 4 : end].decode(), end


def _strings(buf: bytes, at: int, n: int) -> tuple[list[str], int]:
    out = []
    for _ in range(n):
        s, at = _string(buf, at)
        out.append(s)
    return out, at


def _put(strings) -> bytes:
    parts = []
    for s in strings:
        b = (s or "").encode()
        parts += [struct.pack("<I", len(b)), b]
    return b"".join(parts)


def _u32(buf: bytes, at: int) -> tuple[int, int]:
    return struct.unpack_from("<I", buf, at)[0], at + 4


def _citations(rows: np.ndarray) -> list[str | None]:
    return [f"{b}{chr(96 + s) if s else ''}" if b else None for b, s in zip(rows["citation_base"].tolist(), rows["citation_suffix"].tolist())]


def _open_pack(data: bytes, path: str):
    _need(len(data) >= struct.calcsize(PACK_HEAD), path, "too short for a header")
    magic, version, eager_codec, text_codec, search_codec, _, n_blocks, _, _, at, size, raw, folds, words = struct.unpack_from(PACK_HEAD, data)
    _need(magic == PACK_MAGIC and version == PACK_VERSION, path, "not a pack of this version")
    _need(eager_codec == LZMA and text_codec == LZMA, path, "only LZMA sections can be read")
    blocks = np.frombuffer(data, PACK_BLOCK, min(n_blocks, (len(data) - struct.calcsize(PACK_HEAD)) // PACK_BLOCK.itemsize), struct.calcsize(PACK_HEAD))
    eager = _inflate(data[at : at + size], raw, path)
    titles, at = _strings(eager, 0, 4)
    n, at = _u32(eager, at)
    chapters = []
    for _ in range(n):
        ident = struct.unpack_from("<iII", eager, at)
        names, at = _strings(eager, at + 12, 4)
        chapters.append((*ident, *names))
    n, at = _u32(eager, at)
    _need(n * PACK_ROW.itemsize <= len(eager) - at, path, "the row table is cut short")
    rows = np.frombuffer(eager, PACK_ROW, n, at)
    # a range that leaves the table is empty
    chapters = [(c, f, k, *names) if f <= n and k <= n - f else (c, 0, 0, *names) for c, f, k, *names in chapters]
    return {"titles": titles, "chapters": chapters, "rows": rows, "blocks": blocks, "search_codec": search_codec, "folds": folds, "words": words}


def _files(spark: SparkSession, path: str, end: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{end}").load(path)
    return files.select(F.regexp_extract("path", rf"([^/]*)\{end}$", 1).alias("slug"), "path", "content")


def _each(df: DataFrame, read, schema: str) -> DataFrame:
    def run(batches):
        for pdf in batches:
            for slug, path, content in zip(pdf["slug"], pdf["path"], pdf["content"]):
                yield from read(slug, path, bytes(content))

    return df.mapInPandas(run, schema)


def read_packs(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the packs under path."""

    def read(slug, path, data):
        pack = _open_pack(data, path)
        rows, cites = pack["rows"], _citations(pack["rows"])
        for b in pack["blocks"]:
            body, at, texts = _inflate(data[b["text_at"] : b["text_at"] + b["text_len"]], int(b["text_raw"]), path), 0, []
            while at < len(body):
                four, at = _strings(body, at, 4)
                texts.append(four)
            span = slice(int(b["first_row"]), int(b["first_row"]) + len(texts))
            own = rows[span]
            _need(len(own) == len(texts), path, "a block holds rows beyond the table")
            out = pd.DataFrame(texts, columns=["arabic", "narrator", "text", "grades"])
            out.insert(0, "flags", own["flags"])
            out.insert(0, "block", own["block"])
            out.insert(0, "citation", cites[span])
            for c in ("chapter", "id_in_book", "id"):
                out.insert(0, c, own[c])
            out.insert(0, "row", np.arange(span.start, span.stop))
            out.insert(0, "slug", slug)
            yield out

    return _each(_files(spark, path, ".hpk"), read, PACK_SCHEMA)


def read_pack_chapters(spark: SparkSession, path: str) -> DataFrame:
    columns = [c.split()[0] for c in CHAPTER_SCHEMA.split(", ")]

    def read(slug, path, data):
        yield pd.DataFrame([(slug, *c) for c in _open_pack(data, path)["chapters"]], columns=columns)

    return _each(_files(spark, path, ".hpk"), read, CHAPTER_SCHEMA)


def read_pack_titles(spark: SparkSession, path: str) -> DataFrame:
    """Titles, authors and the two fingerprints, which a reader compares with its own."""

    def read(slug, path, data):
        p = _open_pack(data, path)
        yield pd.DataFrame([(slug, *p["titles"], f"{p['folds']:016x}", f"{p['words']:016x}")], columns=["slug", "arabic_title", "arabic_author", "english_title", "english_author", "fold_print", "word_print"])

    return _each(_files(spark, path, ".hpk"), read, "slug string, arabic_title string, arabic_author string, english_title string, english_author string, fold_print string, word_print string")


def read_pack_folds(spark: SparkSession, path: str) -> DataFrame:
    """(slug, row, arabic_fold, english_fold) from the search sections."""

    def read(slug, path, data):
        pack = _open_pack(data, path)
        _need(pack["search_codec"] == LZMA, path, "only LZMA search sections can be read")
        for b in pack["blocks"]:
            body = _inflate(data[b["search_at"] : b["search_at"] + b["search_len"]], int(b["search_raw"]), path)
            n, arabic_size = struct.unpack_from("<II", body)
            _need(8 + 8 * n <= len(body), path, "a search section is cut short")
            lens = np.frombuffer(body, "<u4", 2 * n, 8).astype(np.int64)
            begin = 8 + 8 * n + np.cumsum(lens + 1) - lens - 1  # each fold has a zero byte after it
            _need(int((lens[:n] + 1).sum()) == arabic_size, path, "the Arabic folds have another size")
            folds = [body[s : s + k].decode() for s, k in zip(begin.tolist(), lens.tolist())]
            first = int(b["first_row"])
            yield pd.DataFrame({"slug": slug, "row": np.arange(first, first + n), "arabic_fold": folds[:n], "english_fold": folds[n:]})

    return _each(_files(spark, path, ".hpk"), read, "slug string, row long, arabic_fold string, english_fold string")


def _search_section(arabic: list[str], english: list[str]) -> bytes:
    a, e = [s.encode() for s in arabic], [s.encode() for s in english]
    lens = np.array([*map(len, a), *map(len, e)], "<u4")
    folds = [b"".join(s + b"\0" for s in side) for side in (a, e)]
    return struct.pack("<II", len(a), len(folds[0])) + lens.tobytes() + folds[0] + folds[1]


def pack_files(rows: DataFrame, chapters: DataFrame, titles: DataFrame, *, block_bytes: int = 1 << 18, fold_print: str = "0", word_print: str = "0") -> DataFrame:
    """(slug, content) of a pack for each book. rows: slug, row (0, 1, ...), id, id_in_book, chapter, citation_base,
    citation_suffix, flags, arabic, narrator, text, grades, arabic_fold, english_fold; chapters and titles as they are read."""
    text = ["arabic", "narrator", "text", "grades"]
    sizes = rows.select(F.col("slug").alias("book"), "row", (sum((F.octet_length(F.coalesce(c, F.lit(""))) for c in text), F.lit(16))).cast("long").alias("bytes"))
    placed = rows.join(block_assignment(sizes, block_bytes).withColumnRenamed("book", "slug"), ["slug", "row"])

    def squeeze(key, pdf):
        pdf = pdf.sort_values("row")
        shown = _put(s for four in pdf[text].itertuples(index=False) for s in four)
        found = _search_section(pdf["arabic_fold"].fillna("").tolist(), pdf["english_fold"].fillna("").tolist())
        table = np.zeros(len(pdf), PACK_ROW)
        for c in ("id", "id_in_book", "chapter", "citation_base", "citation_suffix", "block", "flags"):
            table[c] = pdf[c].fillna(0)
        return pd.DataFrame([(key[0], int(key[1]), int(pdf["row"].iloc[0]), lzma.compress(shown), len(shown), lzma.compress(found), len(found), table.tobytes())], columns=["slug", "block", "first_row", "shown", "shown_raw", "found", "found_raw", "table"])

    squeezed = placed.groupBy("slug", "block").applyInPandas(squeeze, "slug string, block int, first_row long, shown binary, shown_raw long, found binary, found_raw long, table binary")

    def assemble(key, blocks, chapters, titles):
        blocks, chapters = blocks.sort_values("block"), chapters.sort_values("first_row")
        _need(len(titles) == 1, key[0], "a book needs one row of titles")
        _need(len(blocks) < 1 << 16, key[0], "too many blocks")
        rows = b"".join(map(bytes, blocks["table"]))
        n_rows = len(rows) // PACK_ROW.itemsize
        _need(chapters["first_row"].tolist() == [0, *np.cumsum(chapters["n_rows"])[:-1]] and chapters["n_rows"].sum() == n_rows and (chapters["n_rows"] > 0).all(), key[0], "the chapters do not cover the rows")
        eager = _put(titles[["arabic_title", "arabic_author", "english_title", "english_author"]].iloc[0]) + struct.pack("<I", len(chapters))
        for c in chapters.itertuples(index=False):
            eager += struct.pack("<iII", c.chapter, c.first_row, c.n_rows) + _put([c.arabic, c.english, c.arabic_fold, c.english_fold])
        eager += struct.pack("<I", n_rows) + rows
        squeezed_eager = lzma.compress(eager)
        at = struct.calcsize(PACK_HEAD) + len(blocks) * PACK_BLOCK.itemsize
        head = struct.pack(PACK_HEAD, PACK_MAGIC, PACK_VERSION, LZMA, LZMA, LZMA, 0, len(blocks), len(chapters), n_rows, at, len(squeezed_eager), len(eager), int(fold_print, 16), int(word_print, 16))
        at += len(squeezed_eager)
        index, payload = np.zeros(len(blocks), PACK_BLOCK), []
        for i, b in enumerate(blocks.itertuples(index=False)):
            index[i] = (b.first_row, at, len(b.shown), b.shown_raw, at + len(b.shown), len(b.found), b.found_raw)
            at += len(b.shown) + len(b.found)
            payload += [bytes(b.shown), bytes(b.found)]
        _need(at < 1 << 32, key[0], "a pack must be under 4 GB")
        return pd.DataFrame([(key[0], head + index.tobytes() + squeezed_eager + b"".join(payload))], columns=["slug", "content"])

    # three inputs meet by book: the chapters and titles ride together
    small = titles.join(chapters.groupBy("slug").agg(F.collect_list(F.struct(*(c for c in chapters.columns if c != "slug"))).alias("chapters")), "slug")

    def both(key, left, right):
        listed = [c.asDict() if hasattr(c, "asDict") else dict(c) for c in right["chapters"].iloc[0]] if len(right) else []
        return assemble(key, left, pd.DataFrame(listed, columns=["chapter", "first_row", "n_rows", "arabic", "english", "arabic_fold", "english_fold"]), right)

    return squeezed.groupBy("slug").cogroup(small.groupBy("slug")).applyInPandas(both, "slug string, content binary")


def write_files(files: DataFrame, folder: str, end: str) -> DataFrame:
    """Writes each (slug, content) as a file of a folder, a path or URI that all executors share, and returns (slug, path,
    bytes). A file appears whole, by renaming, so a repeated task does no harm."""

    def run(batches):
        for pdf in batches:
            out = []
            for slug, content in zip(pdf["slug"], pdf["content"]):
                path = f"{folder.rstrip('/')}/{slug}{end}"
                put_file(path, content)
                out.append((slug, path, len(content)))
            yield pd.DataFrame(out, columns=["slug", "path", "bytes"])

    return files.select("slug", "content").mapInPandas(run, "slug string, path string, bytes long")


# the encyclopedia


def _table(buf: bytes, at: int, path: str) -> tuple[list[list[str]], int]:
    n, at = _u32(buf, at)
    _need(n <= (len(buf) - at) // 8 + 1, path, "a table is cut short")
    out = []
    for _ in range(n):
        k, at = _u32(buf, at)
        row, at = _strings(buf, at, k)
        out.append(row)
    return out, at


def _put_table(rows: list[list[str]]) -> bytes:
    return struct.pack("<I", len(rows)) + b"".join(struct.pack("<I", len(r)) + _put(r) for r in rows)


def _open_henc(data: bytes, path: str):
    _need(len(data) >= struct.calcsize(BOOK_HEAD), path, "too short for a header")
    magic, version, per_block, size, raw, n_blocks, n_entries, n_tree = struct.unpack_from(BOOK_HEAD, data)
    _need(magic == BOOK_MAGIC and version == BOOK_VERSION, path, "not an encyclopedia of this version")
    at = struct.calcsize(BOOK_HEAD)
    _need(n_blocks <= (len(data) - at) // BOOK_BLOCK.itemsize, path, "the block table is cut short")
    blocks = np.frombuffer(data, BOOK_BLOCK, n_blocks, at)
    at += n_blocks * BOOK_BLOCK.itemsize
    head = _inflate(data[at : at + size], raw, path)
    tree, end = _table(head, 0, path)
    light, _ = _table(head, end, path)
    _need(len(tree) == n_tree and len(light) == n_entries, path, "the header's counts differ")
    return blocks, at + size, tree, light


def read_entries(spark: SparkSession, path: str, part: str = "full") -> DataFrame:
    """part: `full` (all fields, with position), `light` (fields for lists) or `tree` (categories)."""
    fields = {"full": FULL, "light": LIGHT, "tree": TREE}[part]

    def kind(c: str) -> str:
        return "array<string>" if c in LISTS else "long" if c in ("direct", "total") else "string"

    def frame(slug, rows, first):
        out = pd.DataFrame(rows, columns=fields)
        for c in fields:
            if c in LISTS:
                out[c] = [s.split("," if c == "categories" else "\x1f") if s else [] for s in out[c]]
            elif kind(c) == "long":
                out[c] = out[c].astype("int64")
        if part == "tree":
            out["parent"] = out["parent"].map(lambda p: p or None)
        out.insert(0, "position", np.arange(first, first + len(rows)))
        out.insert(0, "slug", slug)
        return out

    def read(slug, path, data):
        blocks, start, tree, light = _open_henc(data, path)
        if part != "full":
            yield frame(slug, tree if part == "tree" else light, 0)
            return
        for b in blocks:
            at = start + int(b["at"])
            yield frame(slug, _table(_inflate(data[at : at + int(b["size"])], int(b["raw"]), path), 0, path)[0], int(b["first"]))

    return _each(_files(spark, path, ".henc"), read, "slug string, position long, " + ", ".join(f"{c} {kind(c)}" for c in fields))


def henc_content(tree: list[list[str]], entries: list[list[str]], per_block: int = PER_BLOCK) -> bytes:
    """An encyclopedia from its tree and full records (strings, lists joined already). For one file, so on one worker."""
    light = [[e[0], e[1], e[10], e[11], e[16], e[15]] for e in entries]
    head = _put_table(tree) + _put_table(light)
    blocks, payload, at = [], [], 0
    for first in range(0, len(entries), per_block):
        raw = _put_table(entries[first : first + per_block])
        blob = lzma.compress(raw)
        blocks.append((first, at, len(blob), len(raw)))
        payload.append(blob)
        at += len(blob)
    squeezed = lzma.compress(head)
    return struct.pack(BOOK_HEAD, BOOK_MAGIC, BOOK_VERSION, per_block, len(squeezed), len(head), len(blocks), len(entries), len(tree)) + np.array(blocks, BOOK_BLOCK).tobytes() + squeezed + b"".join(payload)


def entry_files(tree: DataFrame, entries: DataFrame, per_block: int = PER_BLOCK) -> DataFrame:
    """(slug, content) of an encyclopedia for each slug. tree: slug, position and the fields of TREE; entries: slug, position
    and the fields of FULL, as ``read_entries`` gives them. A file is made by one task, as its header holds all entries."""

    def joined(pdf, fields):
        pdf = pdf.sort_values("position")
        text = lambda c, v: ("," if c == "categories" else "\x1f").join(v if v is not None else []) if c in LISTS else "" if v is None else str(v)
        return [[text(c, v) for c, v in zip(fields, row)] for row in pdf[fields].itertuples(index=False, name=None)]

    def make(key, left, right):
        return pd.DataFrame([(key[0], henc_content(joined(right, TREE), joined(left, FULL), per_block))], columns=["slug", "content"])

    return entries.groupBy("slug").cogroup(tree.groupBy("slug")).applyInPandas(make, "slug string, content binary")


# word vectors


def _open_svec(data: bytes, path: str, revision: int | None, fingerprint: str | None):
    def u32(at):
        _need(at + 4 <= len(data), path, "cut short")
        return _u32(data, at)

    magic, at = u32(0)
    _need(magic == VECTOR_MAGIC, path, "not a vector pack")
    dimension, at = u32(at)
    own_revision, at = u32(at)
    size, at = u32(at)
    own_print = data[at : at + size].decode()
    at += size
    _need(revision in (None, own_revision) and fingerprint in (None, own_print), path, "made by another model or from other texts: build it again")
    n_words, at = u32(at)
    n_items, at = u32(at)
    size, at = u32(at)
    words = data[at : at + size].decode().split("\n") if size else []
    at += size
    size, at = u32(at)
    keys = data[at : at + size].decode().split("\n") if size else None
    at += size
    width, at = u32(at)
    _need(width in (2, 4) and len(words) == n_words and (keys is None or len(keys) == n_items), path, "its counts differ")
    _need(n_words * dimension * 2 <= len(data) - at, path, "the vectors are cut short")
    vectors = np.frombuffer(data, "<f2", n_words * dimension, at).reshape(n_words, dimension)
    return words, keys, vectors, n_items, width, at + vectors.nbytes


def read_vectors(spark: SparkSession, path: str, revision: int | None = None, fingerprint: str | None = None) -> DataFrame:
    """(slug, word, vector). A pack of another revision or fingerprint is refused."""

    def read(slug, path, data):
        words, _, vectors, *_ = _open_svec(data, path, revision, fingerprint)
        for at in range(0, len(words), 4096):
            yield pd.DataFrame({"slug": slug, "word": words[at : at + 4096], "vector": list(vectors[at : at + 4096].astype(np.float32))})

    return _each(_files(spark, path, ".svec"), read, "slug string, word string, vector array<float>")


def read_vector_items(spark: SparkSession, path: str, revision: int | None = None, fingerprint: str | None = None) -> DataFrame:
    """(slug, position, key, words) of the items; key is null where the pack has none."""

    def read(slug, path, data):
        words, keys, _, n_items, width, at = _open_svec(data, path, revision, fingerprint)
        rows = []
        for i in range(n_items):
            n, at = _u32(data, at)
            _need(n * width <= len(data) - at, path, "an item is cut short")
            own = np.frombuffer(data, f"<u{width}", n, at)
            at += n * width
            rows.append((slug, i, keys[i] if keys else None, [words[k] for k in own.tolist()]))
            if len(rows) == 4096 or i == n_items - 1:
                yield pd.DataFrame(rows, columns=["slug", "position", "key", "words"])
                rows = []

    return _each(_files(spark, path, ".svec"), read, "slug string, position long, key string, words array<string>")


def svec_content(vectors: dict[str, list[float]], items: list[list[str]], keys: list[str] | None = None, revision: int = 0, fingerprint: str = "") -> bytes:
    """A vector pack: unit vectors in half precision, words and items by index. For one file, so on one worker."""
    words = list(vectors)
    v = np.array([vectors[w] for w in words], np.float64).reshape(len(words), -1)
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype("<f2") if len(words) else v.astype("<f2")
    place, width = {w: i for i, w in enumerate(words)}, 2 if len(words) < 1 << 16 else 4
    joined, own_print, key_blob = "\n".join(words).encode(), fingerprint.encode(), "\n".join(keys or []).encode()
    out = [struct.pack("<IIII", VECTOR_MAGIC, v.shape[1], revision, len(own_print)), own_print, struct.pack("<III", len(words), len(items), len(joined)), joined, struct.pack("<I", len(key_blob)), key_blob, struct.pack("<I", width), v.tobytes()]
    for item in items:
        out += [struct.pack("<I", len(item)), np.array([place[w] for w in item], f"<u{width}").tobytes()]
    return b"".join(out)


def vector_files(vectors: DataFrame, items: DataFrame, revision: int = 0, fingerprint: str = "") -> DataFrame:
    """(slug, content) of a vector pack for each slug. vectors: slug, word, vector; items: slug, position, key, words, as they
    are read; keys are left out where any is null. A file is made by one task, as items name words by their place in it."""

    def make(key, words, rows):
        words, rows = words.sort_values("word"), rows.sort_values("position")
        keys = rows["key"].tolist() if len(rows) and rows["key"].notna().all() else None
        content = svec_content(dict(zip(words["word"], words["vector"])), [list(x) for x in rows["words"]], keys, revision, fingerprint)
        return pd.DataFrame([(key[0], content)], columns=["slug", "content"])

    return vectors.groupBy("slug").cogroup(items.groupBy("slug")).applyInPandas(make, "slug string, content binary")
