"""Operator 1: token ids as binary shards in a frequency-ranked, byte-aligned variable-length coding.

Documents are dealt into ranges of ascending id, sorted inside each range, tokenised, and written as shards. A shard ranks
its own ids by frequency over all its documents and stores, for each token, the rank in 1 to 4 bytes; the byte counts,
two bits a token, stand apart in control bytes. A reader finds byte counts and places through a 256 x 4 table, so a
shard is decoded without a loop over tokens.

Shard layout, little-endian: magic ``RTKV0001``; u64 documents, tokens, table entries, data bytes; then
i64 doc ids, u8 "doc id is there" flags, u32 tokens of each document, u32 ids by rank, control bytes, data bytes.

Defined results: a null text counts as empty (its document holds the end id only); a null doc id stands before all
others and stays null; repeated rows are all written, one after another; an empty table gives no rows; other columns,
whatever their names, are not read. Documents with equal ids come in an order that their place in the input decides, which
also splits an id that many rows share. A text of any length is one document of one shard.

Shards are named by task attempt and read through the manifest alone, which Spark commits with the job: what a lost or
late attempt leaves behind is never read and overwrites nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import attempt, get_file, put_file, table, trim, work_dir
from .tokens import default_path, encoder

MAGIC = b"RTKV0001"
#: Text bytes that one range of doc ids should hold, and ids that one shard holds at most (but for a single longer text).
RANGE_BYTES = 32 << 20
SHARD_TOKENS = 4 << 20
#: Ranges whose shards one file of the manifest names.
RANGES_A_FILE = 4096
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids by descending frequency, ties to the smaller id; control bytes; data bytes)."""
    ids = np.asarray(ids, np.uint32)
    if not len(ids):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint8), np.zeros(0, np.uint8)
    if int(ids.max()) < 1 << 22:
        count = np.bincount(ids)
        there = np.flatnonzero(count)
        by_rank = there[np.argsort(-count[there], kind="stable")].astype(np.uint32)
        rank_of = np.zeros(len(count), np.uint32)
        rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
        rank = rank_of[ids]
    else:
        there, inverse, count = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        by_rank = there[order]
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        rank = place[inverse]
    size = (1 + (rank > 0xFF) + (rank > 0xFFFF) + (rank > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-len(size) % 4 + len(size), np.uint8)
    padded[: len(size)] = size - 1
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    ends = np.cumsum(size, dtype=np.int64)
    data = np.zeros(int(ends[-1]), np.uint8)
    begin = ends - size
    for k in range(4):
        own = size > k
        if not own.any():
            break
        data[begin[own] + k] = (rank[own] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return by_rank, control.astype(np.uint8), data


def decode_ids(n: int, by_rank: np.ndarray, control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The n ids, by table lookup."""
    if not n:
        return np.zeros(0, np.uint32)
    size = _LENGTHS[control].reshape(-1)[:n]
    begin = np.cumsum(size, dtype=np.int64) - size
    buf = np.zeros(len(data) + 4, np.uint8)
    buf[: len(data)] = data
    words = np.ndarray((len(data) + 1,), np.dtype("<u4"), buf, 0, (1,))
    return by_rank[words[begin] & _MASK[size]]


def pack_shard(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    by_rank, control, data = encode_ids(ids)
    head = np.array([len(doc_ids), len(ids), len(by_rank), len(data)], "<u8")
    there = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join([MAGIC, head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), there.tobytes(), np.asarray(counts, "<u4").tobytes(), by_rank.astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def unpack_shard(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, whether each is there, tokens of each document, all ids)."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token shard")
    docs, tokens, entries, size = (int(x) for x in np.frombuffer(raw, "<u8", 4, 8))
    at = 40
    out = []
    for kind, n in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u4", entries), ("u1", (tokens + 3) // 4), ("u1", size)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    if at != len(raw) or int(out[2].sum()) != tokens:
        raise ValueError("token shard is cut or damaged")
    return out[0], out[1].astype(bool), out[2], decode_ids(tokens, *out[3:])


MANIFEST = "range int, shard int, path string, n_docs long, n_tokens long, n_bytes long"


def write_token_file(docs: DataFrame, out_dir: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, range_bytes: int = RANGE_BYTES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes docs below out_dir and returns the manifest, a row for each shard, which is itself stored there."""
    spark, path = docs.sparkSession, tokenizer or default_path()
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // range_bytes))

    def write(batches):
        at, shard, held, ids, counts, total = TaskContext.get().partitionId(), 0, [], [], [], 0
        enc, mine = encoder(path), attempt()

        def flush():
            raw = pack_shard(held, np.concatenate(counts), np.concatenate(ids))
            where = f"{out_dir}/shards/{at:06d}-{shard:05d}-{mine}.tkv"
            put_file(where, raw)
            return pa.RecordBatch.from_pydict({"range": pa.array([at], pa.int32()), "shard": pa.array([shard], pa.int32()), "path": [where], "n_docs": [len(held)], "n_tokens": [total], "n_bytes": [len(raw)]})

        for batch in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
            got, sizes = enc.encode_column(batch.column(1))
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            flat = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
            body = np.ones(len(flat), bool)
            body[ends - 1] = False
            flat[body] = got
            doc_ids, a = batch.column(0).to_pylist(), 0
            while a < len(doc_ids):
                base = ends[a] - sizes[a]
                b = max(int(np.searchsorted(ends, base + shard_tokens - total, "right")), a + (total == 0))
                if b > a:
                    held += doc_ids[a:b]
                    counts.append(sizes[a:b])
                    ids.append(flat[base : ends[b - 1]])
                    total += int(ends[b - 1] - base)
                    a = b
                if a < len(doc_ids):
                    yield flush()
                    shard, held, ids, counts, total = shard + 1, [], [], [], 0
        if held:
            yield flush()
        trim()

    own = own.withColumn("place", F.monotonically_increasing_id())
    dealt = own.repartitionByRange(n, "doc_id", "place").sortWithinPartitions("doc_id", "place").drop("place")
    # a row for each shard: a file holds the rows of many ranges
    dealt.mapInArrow(write, MANIFEST).repartition(-(-n // RANGES_A_FILE)).write.parquet(f"{out_dir}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


def read_token_file(spark: SparkSession, out_dir: str, *, with_ids: bool = True, shards_a_task: int = 4) -> DataFrame:
    """The documents of a token file: doc_id, start (ids before it in the whole file), n_tokens, ids_crc32 and, if asked, ids."""
    shards = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")
    # a range's shards are summed first, so that what one task orders is three numbers for each range of RANGE_BYTES
    ranges = shards.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    placed = placed.join(ranges, F.col("range") == F.col("r")).select("path", (F.col("start") + F.col("base")).cast("long").alias("start"))

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                doc_ids, there, counts, ids = unpack_shard(get_file(path))
                ends = np.cumsum(counts, dtype=np.int64)
                begin = ends - counts
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), ends.tolist())]
                out = {"doc_id": pa.array(doc_ids, pa.int64(), mask=~there), "start": begin + start, "n_tokens": counts.astype(np.int64), "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(np.append(begin, len(ids)).astype(np.int32), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    # shards are dealt by name; a shard is the unit that is read at a time
    return placed.repartition(max(1, -(-shards.count() // shards_a_task)), "path").mapInArrow(read, schema)


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "tokens")
    write_token_file(table(spark, sf_dir, "documents"), out)
    return read_token_file(spark, out, with_ids=False)
