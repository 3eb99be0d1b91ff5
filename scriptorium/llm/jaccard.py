"""Operator 10: join of texts whose word n-gram sets have a Jaccard similarity of at least a threshold, by MinHash banding.

1. Each text becomes the set of its n-gram hashes, a MinHash signature and the hashes of its bands; texts with equal sets
   are one class, a node of its own. Bands and rows follow from the target recall (``choose_bands``). A class is
   represented by the row of it with the smallest id, or of those the smallest MD5 of the text.
2. Band hashes are shuffled. Buckets are counted, never gathered; buckets with the same members are one.
3. The text of a class goes once to each of its buckets. A bucket with more than BLOCK classes, or n-grams than BLOCK_GRAMS,
   is split into blocks, and each pair of blocks is a task's unit of its own, so no bucket is ever whole in a task and a
   unit is bounded in bytes (but for a single longer text). Pairs are verified on the full sets in the first bucket that
   they share; a unit returns one row for each class with a link, never the pairs.
4. Links are summed for each class; groups are the connected components of the links (alternating star contraction).

Words are runs of bytes other than ASCII white space, punctuation and symbols, in lower case. A text of fewer than n words
(at least one) has one n-gram, of all its words. Hashes have 64 bits.

Defined results: a null text, and a row with a null id, has no links and a null set; texts without a word are linked only
if they are equal; rows with the same id and text count as two documents, and different texts with one id are documents of
their own, though their class ids, being ids, may then be equal by name; an empty table gives no rows; other columns,
whatever their names, are not read; a text of any length is compared whole.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, slots, table, text_bytes, trim

N, THRESHOLD, RECALL, MAX_HASHES, BLOCK, BLOCK_GRAMS = 5, 0.8, 0.9999, 128, 512, 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 18
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall at the threshold with at most max_hashes hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        miss = 1 - threshold**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if 0 < miss < 1 else 1
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, _SLICE + 16)
            inverse = np.uint64(pow(int(_P), -1, 1 << 64))
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _P)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse)]), dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _word_hashes(b: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, text of each word) of texts that lie one after another in b."""
    n = len(b)
    inside = np.zeros(n + 2, bool)
    inside[1 : n + 1] = _WORD[b]
    edge = np.zeros(n + 2, bool)
    edge[starts[lens > 0]] = True  # a word ends where its text ends
    step = inside[1:] & (~inside[:-1] | edge[:-1])
    begin = np.flatnonzero(step[: n + 1])
    stop = inside[:-1] & (~inside[1:] | edge[:-1])
    end = np.flatnonzero(stop)
    end = end[end > 0]
    up, down = _POWERS.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = _mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    full = np.flatnonzero(lens)
    return h, full[np.searchsorted(starts[full], begin, "right") - 1] if len(full) else begin


def shingle_sets(col: pa.Array, n: int = N) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes (uint64) of each text; the column is in lower case already."""
    data, starts, lens = text_bytes(col)
    out: list[np.ndarray] = []
    at, total = 0, np.cumsum(lens)
    while at < len(lens):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + _SLICE, "right")))
        own_lens = lens[at:to]
        # texts side by side, without what lies under null rows
        own = np.concatenate([data[s : s + k] for s, k in zip(starts[at:to].tolist(), own_lens.tolist())])
        own_starts = np.cumsum(own_lens) - own_lens
        h, owner = _word_hashes(own, own_starts, own_lens)
        words = np.bincount(owner, minlength=to - at) if len(owner) else np.zeros(to - at, np.int64)
        first = np.cumsum(words) - words
        grams = np.where(words >= n, words - n + 1, (words > 0).astype(np.int64))
        g_first = np.cumsum(grams) - grams
        text = np.repeat(np.arange(to - at), grams)
        place = first[text] + np.arange(len(text)) - g_first[text]
        size = np.minimum(words, n)[text]
        padded = np.concatenate([h, np.zeros(n, np.uint64)])
        gram = np.zeros(len(text), np.uint64)
        for k in range(n):
            gram = np.where(k < size, _mix(gram * _P + padded[place + k] + np.uint64(k + 1)), gram)
        order = np.lexsort((gram, text))
        gram, text = gram[order], text[order]
        keep = np.ones(len(gram), bool)
        keep[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
        out += np.split(gram[keep], np.cumsum(np.bincount(text[keep], minlength=to - at))[:-1])
        at = to
    return out


def band_hashes(sets: list[np.ndarray], bands: int, rows: int, seed: int = 1) -> np.ndarray:
    """A row of band hashes (int64, never 0) for each set that has a member."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
    c = rng.integers(0, 1 << 32, bands * rows, np.uint32)
    out = np.zeros((len(sets), bands), np.int64)
    at = 0
    sizes = np.array([len(s) for s in sets], np.int64)
    total = np.cumsum(sizes)
    while at < len(sets):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + 32768, "right")))
        x = (np.concatenate(sets[at:to]) >> np.uint64(32)).astype(np.uint32)
        begin = np.cumsum(sizes[at:to]) - sizes[at:to]
        sig = np.empty((bands * rows, to - at), np.uint32)
        for k in range(bands * rows):
            sig[k] = np.minimum.reduceat(x * a[k] + c[k], begin)
        h = np.full((bands, to - at), np.uint64(0), np.uint64)
        for r in range(rows):
            h = _mix(h * _P + sig[r::rows].astype(np.uint64) + np.uint64(r + 1))
        out[at:to] = (h | np.uint64(1)).T.astype(np.int64)
        at = to
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key (MD5 of the text), cls (class of equal n-gram sets; null for a null text or id), n_grams and bands (null
    without a word)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text_col).alias("key"), F.lower(text_col).alias("t"))

    def sketch(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = shingle_sets(batch.column("t"), n)
                full = [i for i, s in enumerate(sets) if len(s)]
                got = band_hashes([sets[i] for i in full], bands, rows)
                cls: list = [None] * len(sets)
                lists: list = [None] * len(sets)
                for i, h in zip(full, got):
                    cls[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).hexdigest()
                    lists[i] = h
                for i, s in enumerate(sets):
                    if not len(s) and batch.column("t")[i].is_valid:
                        cls[i] = "=" + hashlib.blake2b(batch.column("t")[i].as_py().encode(), digest_size=16).hexdigest()
                ids = batch.column(0)
                cls = [c if v else None for c, v in zip(cls, ids.is_valid().to_pylist())]
                grams = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, batch.column("key"), pa.array(cls, pa.string()), grams, pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "key", "cls", "n_grams", "bands"])
        trim()

    return own.mapInArrow(sketch, "doc_id long, key string, cls string, n_grams long, bands array<long>")


class _Unit:
    """The classes of one block, or of two blocks, of one bucket."""

    def __init__(self, band: int, bi: int, bj: int):
        self.band, self.bi, self.bj = band, bi, bj
        self.seen: set[int] = set()
        self.node: list[int] = []
        self.weight: list[int] = []
        self.block: list[int] = []
        self.owners: list[np.ndarray] = []
        self.sets: list[np.ndarray] = []

    def add(self, node: int, weight: int, block: int, owners: np.ndarray, grams: np.ndarray) -> None:
        """A class; a repeated row of one counts once."""
        if node not in self.seen:
            self.seen.add(node)
            self.node.append(node)
            self.weight.append(weight)
            self.block.append(block)
            self.owners.append(owners)
            self.sets.append(grams)

    def links(self, threshold: float):
        """(node, documents linked to it here, smallest node of its component here) for each class with a link."""
        keep = sorted(range(len(self.node)), key=lambda i: (self.block[i], len(self.sets[i]), self.node[i]))
        if len(keep) < 2:
            return []
        size = np.array([len(self.sets[i]) for i in keep])
        block = np.array([self.block[i] for i in keep])
        owners = np.stack([self.owners[i] for i in keep])
        sets = [self.sets[i] for i in keep]
        weight = [self.weight[i] for i in keep]
        root = list(range(len(keep)))
        linked = [0] * len(keep)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in range(len(keep)):
            other = np.flatnonzero(block == self.bj)
            other = other[other > i] if self.bi == self.bj else other if block[i] == self.bi else other[:0]
            other = other[(np.minimum(size[other], size[i]) >= threshold * np.maximum(size[other], size[i]) - 1e-9)]
            if not len(other):
                continue
            same = owners[other] == owners[i]
            same &= owners[i] != 0
            other = other[same.argmax(axis=1) == self.band]
            if not len(other):
                continue
            joined = np.concatenate([sets[j] for j in other])
            where = np.searchsorted(sets[i], joined)
            hit = sets[i][np.minimum(where, size[i] - 1)] == joined
            common = np.add.reduceat(hit, np.cumsum(size[other]) - size[other], dtype=np.int64)
            union = size[i] + size[other] - common
            for j in other[common >= threshold * union - 1e-9].tolist():
                linked[i] += weight[j]
                linked[j] += weight[i]
                a, b = find(i), find(j)
                if a != b:
                    root[b] = a
        least: dict[int, int] = {}
        for i, k in enumerate(keep):
            least[find(i)] = min(least.get(find(i), self.node[k]), self.node[k])
        return [(self.node[k], linked[i], least[find(i)]) for i, k in enumerate(keep) if linked[i]]


def verified_links(docs: DataFrame, sig: DataFrame, id_col: str, text_col: str, n: int, bands: int, threshold: float, block: int, block_grams: int) -> tuple[DataFrame, DataFrame]:
    """(classes: cls, node, rep, key, size; links: node, linked, root), both stored."""
    spark = docs.sparkSession
    reps = sig.filter("cls is not null").groupBy("cls").agg(F.min(F.struct("doc_id", "key", "n_grams", "bands")).alias("m"), F.count("*").alias("size"))
    reps = reps.select("cls", F.monotonically_increasing_id().alias("node"), F.col("m.doc_id").alias("rep"), "m.key", "m.n_grams", "m.bands", "size")
    reps = materialise(reps, "classes")
    rows = reps.filter("bands is not null").select("node", "n_grams", F.posexplode("bands").alias("band", "h"))
    mark = F.xxhash64("node", F.lit("m"))
    buckets = rows.groupBy("band", "h").agg(F.count("*").alias("m"), F.sum("n_grams").alias("grams"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(mark).alias("y"), F.min("node").alias("lo")).filter("m > 1")
    buckets = buckets.groupBy("m", "x", "y", "lo").agg(F.min(F.struct("band", "h", "grams")).alias("b"))
    buckets = buckets.select("b.band", "b.h", F.ceil(F.greatest(F.col("m") / block, F.col("b.grams") / block_grams)).cast("int").alias("nb"))
    member = rows.join(buckets, ["band", "h"]).groupBy("node").agg(F.collect_list(F.struct("band", "h", "nb")).alias("buckets"))  # at most one for each band
    member = materialise(member.join(reps.select("node", "rep", "key", "size"), "node"), "members")
    own = docs.select(F.col(id_col).cast("long").alias("rep"), F.md5(text_col).alias("key"), F.lower(text_col).alias("t")).filter("t is not null")
    # texts meet their classes by shuffle at every size: both sides grow with the input
    sent = own.join(member.hint("merge"), ["rep", "key"]).withColumn("b", F.explode("buckets"))
    sent = sent.withColumns({"own": F.pmod(F.xxhash64("node", F.lit("b")), F.col("b.nb")).cast("int")})
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b.nb") - 1)))
    sent = sent.select(
        F.col("b.band").alias("band"), F.col("b.h").alias("h"), F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "node", "size",
        F.transform("buckets", lambda x: x["band"]).alias("bands"), F.transform("buckets", lambda x: x["h"]).alias("hs"), "t",
    )

    def verify(batches):
        unit, key, out = None, None, []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["node", "linked", "root"])

        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = shingle_sets(batch.column("t"), n)
                cols = [batch.column(c).to_pylist() for c in ("band", "h", "bi", "bj", "own", "node", "size", "bands", "hs")]
                for (band, h, bi, bj, mine, node, size, own_bands, own_hs), s in zip(zip(*cols), sets):
                    if key != (band, h, bi, bj):
                        if unit:
                            out += unit.links(threshold)
                        unit, key = _Unit(band, bi, bj), (band, h, bi, bj)
                    owners = np.zeros(bands, np.int64)
                    owners[own_bands] = own_hs
                    unit.add(node, size, mine, owners, s)
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
        if unit:
            out += unit.links(threshold)
        if out:
            yield batch_of(out)
        trim()

    dealt = sent.repartition(max(slots(spark), 2 * spark.sparkContext.defaultParallelism), "band", "h", "bi", "bj").sortWithinPartitions("band", "h", "bi", "bj")
    links = materialise(dealt.mapInArrow(verify, "node long, linked long, root long"), "links")
    discard(member)
    return reps, links


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for edges (a, b): root is the smallest node of the component. Alternates large-star and small-star
    steps, each stored, until nothing changes; rounds grow with the logarithm of the number of nodes."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = materialise(e, "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        last, e = e, materialise(small, "edges")
        discard(last)
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            out.stored_at = e.stored_at
            return out
        before = now
    raise RuntimeError("components did not settle")


def grouped_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES, block: int = BLOCK, block_grams: int = BLOCK_GRAMS) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, key, cls and more; classes: cls, rep, key, class_id, n_links, stays), both stored. stays: whether the
    class has the smallest (id, key) of its group."""
    bands, rows = choose_bands(threshold, recall, max_hashes)
    sig = materialise(signatures(docs, id_col, text_col, n, bands, rows), "signatures")
    classes, links = verified_links(docs, sig, id_col, text_col, n, bands, threshold, block, block_grams)
    found = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    groups = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    groups = groups.join(classes.select("node", "rep", "key"), "node").select("node", "root", "rep", "key")
    first = groups.groupBy("root").agg(F.min(F.struct("rep", "key", "node")).alias("first"))
    groups = groups.select("node", "root").join(first, "root").select("node", F.col("first.rep").alias("class_id"), (F.col("node") == F.col("first.node")).alias("stays"))
    of_class = classes.select("cls", "node", "rep", "key", "size").join(links.groupBy("node").agg(F.sum("linked").alias("linked")), "node", "left").join(groups, "node", "left")
    of_class = of_class.select("cls", "rep", "key", F.coalesce("class_id", "rep").alias("class_id"), (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("stays", F.lit(True)).alias("stays"))
    of_class = materialise(of_class, "groups")
    discard(classes, links, found)
    return sig, of_class


def ngram_jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """A row for each document: doc_id, rep (smallest id with the same n-gram set), class_id (smallest id of its group), and
    n_links (other documents with a similarity of at least the threshold). For the options see ``grouped_classes``."""
    sig, of_class = grouped_classes(docs, **options)
    return sig.select("doc_id", "cls").join(of_class.select("cls", "rep", "class_id", "n_links"), "cls", "left").select("doc_id", "rep", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, and of different texts with that id the one with the
    smallest MD5. Rows with a null id or text stay. Rows are told apart by id and text, so a different text that shares an
    id is a document of its own; of rows with equal id and text one stays, the first by its JSON. All columns of docs, whatever
    their names, come back as they are; an empty table gives no rows; texts of any length are compared whole."""
    sig, of_class = grouped_classes(docs)
    stay = of_class.filter("stays").select(F.col("rep").alias("id"), "key")
    often = materialise(sig.filter("cls is not null").groupBy(F.col("doc_id").alias("id"), "key").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")
    discard(sig)
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.md5("text").alias("key"))
    # documents meet what stays by shuffle at every size: both sides grow with the input
    kept = rows.join(stay.hint("merge"), ["id", "key"])
    if not often.isEmpty():
        once = kept.join(often, ["id", "key"]).groupBy("id", "key").agg(F.min_by("doc", F.to_json("doc")).alias("doc"))
        kept = kept.join(often, ["id", "key"], "left_anti").select("doc").unionByName(once.select("doc"))
    return kept.select("doc").unionByName(rows.filter("id is null or key is null").select("doc")).select("doc.*")
