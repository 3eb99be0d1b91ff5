"""Operator 9: sharding by extendible hashing.

A row's hash is a string of bits. The directory starts with one bucket; a bucket whose rows have more than the byte limit
is split on the next bit, and only such buckets are, until every shard fits or holds one row. The whole directory is
worked out from byte sums by hash prefix: rows are summed once by a prefix that is some bits longer than the expected
depth, shorter prefixes are sums of these, and only rows under prefixes that are still too large are summed again with
more bits. A row finds its shard by an equi-join of its prefix with the directory. Nothing is collected but totals.

Bits come from the id's MD5 and, after HASH_BITS of them, from a second MD5 that includes the row's place in the input, so
rows with equal ids can be told apart.

Defined results: a null id hashes like an empty string; a null text has no bytes; a row larger than the limit is alone in
its shard; an empty table gives no rows; other columns are not read. Equal rows with equal ids lie in one shard unless
they exceed the limit together, when their place in the input decides. Columns of any name, clashing ones too, are
written as they are by ``write_shards``; a text of any length is one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fresh, materialise, table

LIMIT_BYTES, HASH_BITS, SPARE_BITS, STEP_BITS = 1 << 20, 60, 3, 8


def _bits(docs: DataFrame, id_col: str) -> Column:
    """2 * HASH_BITS characters 0 and 1."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    bits = lambda c: F.lpad(F.conv(F.substring(F.md5(c), 1, HASH_BITS // 4), 16, 2), HASH_BITS, "0")
    second = F.concat_ws("#", text, F.monotonically_increasing_id().cast("string"))
    return F.concat(bits(text.cast("binary")), bits(second.cast("binary")))


def _n_bytes(text_col: str) -> Column:
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")


PLACED = ["shard", "depth", "shard_bytes", "shard_docs"]


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """Stored rows (n_bytes, bits and any others) with PLACED in place of bits."""
    if limit < 1:
        raise ValueError("limit must be positive")
    others = [c for c in rows.columns if c != "bits"]
    total = rows.agg(F.sum("n_bytes")).first()[0]
    if total is None:
        return rows.select(*others, F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_docs"))
    low, high = 0, min(2 * HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
    out = None
    while True:
        cells = materialise(rows.groupBy(F.substring("bits", 1, high).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs")), "cells")
        nodes = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
        nodes = nodes.groupBy("depth", F.expr("substring(cell, 1, depth)").alias("p")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        fits = (F.col("bytes") <= limit) | (F.col("docs") == 1) | (F.col("depth") == 2 * HASH_BITS)
        over = nodes.filter(~fits).select((F.col("depth") + 1).alias("depth"), F.col("p").alias("parent"))
        good = nodes.filter(fits).withColumn("parent", F.expr("substring(p, 1, greatest(depth - 1, 0))"))
        leaves = good.filter(F.col("depth") == low).unionByName(good.filter(F.col("depth") > low).join(over.hint("merge"), ["depth", "parent"], "left_semi"))
        leaves = leaves.select("depth", F.col("p").alias("shard"), F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"))
        directory = cells.select("cell", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn("shard", F.expr("substring(cell, 1, depth)")).join(leaves.hint("merge"), ["depth", "shard"])
        directory = materialise(directory, "directory")
        # a directory grows with the input, so it meets the rows by shuffle
        found = rows.withColumn("cell", F.substring("bits", 1, high)).join(directory.hint("merge"), "cell").select(*others, *PLACED)
        out = found if out is None else out.unionByName(found)
        left = cells.filter((F.col("bytes") > limit) & (F.col("docs") > 1))
        if high >= 2 * HASH_BITS or left.isEmpty():
            return out
        rows = rows.join(left.select(F.col("cell").alias("left_cell")), F.substring("bits", 1, high) == F.col("left_cell"), "left_semi")
        low, high = high + 1, min(2 * HASH_BITS, high + STEP_BITS)


def shards(docs: DataFrame, limit: int = LIMIT_BYTES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, n_bytes, shard (its bits), depth, shard_bytes, shard_docs."""
    rows = docs.select(F.col(id_col).alias("doc_id"), _n_bytes(text_col).alias("n_bytes"), _bits(docs, id_col).alias("bits"))
    return _placed(materialise(rows, "hash-keys"), limit)


def write_shards(docs: DataFrame, out_dir: str, limit: int = LIMIT_BYTES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs as one Parquet folder for each shard below out_dir; returns the shards: shard, depth, shard_bytes, shard_docs.
    Rows carry their own hash bits, so equal ids and equal rows are each written once. The folder's name is the column
    ``shard_name`` (with underscores after it if docs has such a column)."""
    rows = materialise(docs.select(F.struct("*").alias("doc"), _n_bytes(text_col).alias("n_bytes"), _bits(docs, id_col).alias("bits")), "hash-keys")
    placed = materialise(_placed(rows, limit), "placed")
    name = fresh(docs.columns, "shard_name")
    placed.select("doc.*", F.concat(F.lit("s"), "shard").alias(name)).repartition(name).write.partitionBy(name).parquet(out_dir)
    discard(rows)
    return placed.select(*PLACED).distinct()


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


OP9_SQL = f"""
WITH k AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
n AS (SELECT d, h >> ({HASH_BITS} - d) AS p, sum(n_bytes) AS b, count(*) AS c FROM k, range(0, 31) t(d) GROUP BY 1, 2),
r AS (SELECT doc_id, n_bytes, d, n.p, b, c, row_number() OVER (PARTITION BY doc_id ORDER BY d) AS i
    FROM k, n WHERE (k.h >> ({HASH_BITS} - n.d)) = n.p AND (b <= {LIMIT_BYTES} OR c = 1))
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), CAST(d AS INTEGER), '0') END AS shard, CAST(d AS INTEGER) AS depth,
    CAST(b AS BIGINT) AS shard_bytes, c AS shard_docs
FROM r WHERE i = 1
"""
