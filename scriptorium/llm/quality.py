"""Operator 5: quality rules with adaptive thresholds, in DataFrame functions only.

Each text gets counts of words, symbols, repeated lines and words in repeated 8-word windows. For each language and
source a quantile sketch of each measure is kept: a histogram with buckets that grow by GAMMA, so any quantile is known
to about 1 % and two sketches merge by adding their counts. A group's fence lies SPREADS times the distance from its
median to its 0.8 quantile beyond that quantile, and a lower fence likewise below the 0.2 quantile; so up to a fifth of a
group may be junk without moving its fences far. A distance below the sketch's resolution counts as the resolution. Groups
with under MIN_GROUP documents take the merged sketch of their language, and languages with fewer the merged sketch of all.

A document is kept if it passes the base rule and lies inside the fences of its group. A share beyond its fence counts only
if the count is evidence at all: more than ALLOWED of them and of the text's size (a few symbols in a short text are none).
Where more than 0.8 of a group have none of a kind, its fence is 0 and ALLOWED alone decides.

The measures are stored before the sketches are read, so texts are measured once; fences (a row for each language and
source) are broadcast if there are at most BROADCAST_ROWS of them and joined by shuffle otherwise, where the engine splits
the rows of a hot group. No group of rows is ever gathered: sketches are partial counts.

Defined results: a null text has no words and fails the base rule; null languages and sources are groups of their own;
repeated rows get equal results; an empty table gives no rows; ``with_counts`` and ``with_verdict`` replace columns whose
names clash with outputs, ``quality_stage`` returns all columns of its input as they are; a text of any length is counted
whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, materialise, table

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
GAMMA, FLOOR = 1.02, 1e-4
RESOLUTION = GAMMA - 1
TAIL, SPREADS, MIN_GROUP, BROADCAST_ROWS = 0.8, 6, 100, 50_000
#: Measure: (count, size of the text that it is a share of, fenced below too).
MEASURES = {
    "symbol_share": ("n_symbols", "word_chars", False),
    "dup_line_share": ("n_dup_lines", "n_lines", False),
    "repeat_share": ("n_repeat_words", "n_words", False),
    "word_length": ("word_chars", "n_words", True),
}
#: Count that is no evidence yet: (of any text, and this share of its size).
ALLOWED = {"symbol_share": (2, 0.01), "dup_line_share": (3, 0.05), "repeat_share": (30, 0.02)}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _halves(h: str, by: int) -> Column:
    """hash(h[i], h[i + by]) for each i."""
    return F.expr(f"zip_with({h}, slice({h}, {by + 1}, greatest(size({h}) - {by}, 0)), (a, b) -> xxhash64(a, b))")


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with COUNTS, n_lines and base_failed."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    columns = [c for c in docs.columns if c not in (*COUNTS, "n_lines", "base_failed")]
    w, l, h, s, p = (fresh(docs.columns, x) for x in ("q_words", "q_lines", "q_hashes", "q_sorted", "q_places"))
    d = docs.withColumns({w: F.array_remove(F.split(t, WORD_BREAK), ""), l: F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    d = d.select(
        *(F.col(f"`{c}`") for c in columns),
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(l).cast("long").alias("n_lines"),
        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
        F.transform(w, lambda x: F.xxhash64(x)).alias(h),
    )
    d = d.withColumn(h, _halves(h, 1)).withColumn(h, _halves(h, 2)).withColumn(h, _halves(h, 4))
    # a text has n_words - 7 windows of 8 words; equal windows have equal hashes
    d = d.withColumn(h, F.expr(f"slice({h}, 1, cast(greatest(n_words - 7, 0) as int))"))
    d = d.withColumn(s, F.when(F.size(h) > F.size(F.array_distinct(h)), F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    d = d.drop(h).withColumn(p, F.expr(f"array_sort(transform(filter({s}, (x, j) -> (j > 0 and {s}[greatest(j - 1, 0)].h = x.h) or (j + 1 < size({s}) and {s}[least(j + 1, size({s}) - 1)].h = x.h)), x -> x.i))"))
    d = d.withColumn("n_repeat_words", F.coalesce(F.expr(f"aggregate(zip_with({p}, slice({p}, 2, size({p}) - 1), (a, b) -> least(8, coalesce(b - a, 8))), 0L, (s, x) -> s + x)"), F.lit(0).cast("long")))
    return d.drop(s, p).withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def _share(measure: str) -> str:
    count, size, _ = MEASURES[measure]
    return f"{count} / greatest({size}, 1)"


def _bucket(value: Column) -> Column:
    return F.when(value > FLOOR, F.ceil(F.round(F.log(value / FLOOR) / math.log(GAMMA), 9)).cast("int")).otherwise(0)


def sketches(counted: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """A row for each language, source, measure and bucket: mergeable by adding n."""
    pairs = F.array(*(F.struct(F.lit(k).alias("measure"), _bucket(F.expr(_share(k))).alias("bucket")) for k in MEASURES))
    d = counted.filter("not base_failed").select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.explode(pairs).alias("m"))
    return d.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n"))


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Documents, lower tail, median and upper tail of each sketch, merged to keys."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "measure")
    run = merged.withColumns({"c": F.sum("n").over(w.orderBy("bucket")), "total": F.sum("n").over(w)})
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(F.lit(FLOOR * 2 / (GAMMA + 1)) * F.pow(F.lit(GAMMA), F.col("bucket")))
    at = lambda q: F.min(F.when(F.col("c") >= F.ceil(F.round(F.col("total") * q, 6)), value))
    return run.groupBy(*keys, "measure").agg(F.max("total").alias("docs"), at(1 - TAIL).alias("q1"), at(0.5).alias("q2"), at(TAIL).alias("q3"))


def fences(sketch: DataFrame) -> DataFrame:
    """A row for each language and source: the highest (and lowest) value that each measure may have."""
    own, by_lang, all_ = _quantiles(sketch, ["lang", "source"]), _quantiles(sketch, ["lang"]), _quantiles(sketch, [])
    q = [F.col(c).alias(f"{c}_l") for c in ("docs", "q1", "q2", "q3")]
    f = own.join(by_lang.select(F.col("lang").alias("lang_l"), F.col("measure").alias("measure_l"), *q), F.col("lang").eqNullSafe(F.col("lang_l")) & (F.col("measure") == F.col("measure_l")))
    f = f.join(all_.select(F.col("measure").alias("measure_a"), *(F.col(c).alias(f"{c}_a") for c in ("q1", "q2", "q3"))), F.col("measure") == F.col("measure_a"))
    pick = lambda c: F.when(F.col("docs") >= MIN_GROUP, F.col(c)).when(F.col("docs_l") >= MIN_GROUP, F.col(f"{c}_l")).otherwise(F.col(f"{c}_a"))
    f = f.select("lang", "source", "measure", pick("q1").alias("q1"), pick("q2").alias("q2"), pick("q3").alias("q3"))
    out, least = [], F.col("q2") * RESOLUTION
    for k, (_, _, below) in MEASURES.items():
        one = F.col("measure") == k
        out.append(F.max(F.when(one, F.col("q3") + SPREADS * F.greatest(F.col("q3") - F.col("q2"), least))).alias(f"{k}_most"))
        if below:
            out.append(F.min(F.when(one, F.col("q1") - SPREADS * F.greatest(F.col("q2") - F.col("q1"), least))).alias(f"{k}_least"))
    return f.groupBy("lang", "source").agg(*out)


def with_verdict(counted: DataFrame, *, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counted and stored documents with kept."""
    f = materialise(fences(sketches(counted, lang_col, source_col)), "fences")
    own = {c: fresh(counted.columns, f"fence_{c}") for c in f.columns}
    f = f.withColumnsRenamed(own)
    if f.count() <= BROADCAST_ROWS:
        f = F.broadcast(f)
    joined = counted.join(f, F.col(lang_col).eqNullSafe(F.col(own["lang"])) & F.col(source_col).eqNullSafe(F.col(own["source"])), "left")
    inside = F.lit(True)
    for k, (count, size, below) in MEASURES.items():
        within = F.expr(_share(k)) <= F.col(own[f"{k}_most"])
        if k in ALLOWED:
            within |= F.expr(f"{count} <= {ALLOWED[k][0]} + {ALLOWED[k][1]}D * {size}")
        inside &= within
        if below:
            inside &= F.expr(_share(k)) >= F.col(own[f"{k}_least"])
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop(*own.values())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    counted = materialise(with_counts(docs).drop("text"), "counts")
    return with_verdict(counted).select("doc_id", *COUNTS, "base_failed", "kept")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass; they are stored with their counts once, so that texts are measured once. Null texts go; null
    ids stay; null languages and sources are groups of their own; repeated rows fare alike; all columns of docs, whatever
    their names, come back as they are; an empty table gives no rows; texts are counted whole."""
    packed = docs.select(F.struct("*").alias("doc"), "text", "lang", "source")
    counted = materialise(with_counts(packed).drop("text"), "counted")
    return with_verdict(counted).filter("kept").select("doc.*")


def _sql() -> str:
    value = "CASE WHEN bucket = 0 THEN 0.0 ELSE %r * pow(%r, bucket) END" % (FLOOR * 2 / (GAMMA + 1), GAMMA)
    share = lambda k: _share(k).replace(" / ", "::DOUBLE / ")
    pairs = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS measure, ({share(k)}) AS v FROM c WHERE NOT base_failed" for k in MEASURES)

    def quantiles(name: str, keys: str) -> str:
        k = keys + ", " if keys else ""
        part = f"PARTITION BY {k}measure"
        return f"""{name}_r AS (SELECT {k}measure, bucket, sum(n) OVER ({part} ORDER BY bucket) AS c, sum(n) OVER ({part}) AS total
            FROM (SELECT {k}measure, bucket, sum(n) AS n FROM s GROUP BY {k}measure, bucket)),
        {name} AS (SELECT {k}measure, max(total) AS docs, {', '.join(f"min(CASE WHEN c >= ceil(round(total * {q}, 6)) THEN {value} END) AS q{i}" for i, q in ((1, 1 - TAIL), (2, 0.5), (3, TAIL)))}
            FROM {name}_r GROUP BY {k}measure)"""

    picks = ", ".join(f"CASE WHEN o.docs >= {MIN_GROUP} THEN o.q{i} WHEN l.docs >= {MIN_GROUP} THEN l.q{i} ELSE a.q{i} END AS q{i}" for i in (1, 2, 3))
    bounds, inside = [], []
    for k, (count, size, below) in MEASURES.items():
        bounds.append(f"max(CASE WHEN measure = '{k}' THEN q3 + {SPREADS} * greatest(q3 - q2, q2 * {RESOLUTION!r}) END) AS {k}_most")
        allowed = f" OR {count} <= {ALLOWED[k][0]} + {ALLOWED[k][1]}::DOUBLE * {size}" if k in ALLOWED else ""
        inside.append(f"({share(k)} <= {k}_most{allowed})")
        if below:
            bounds.append(f"min(CASE WHEN measure = '{k}' THEN q1 - {SPREADS} * greatest(q2 - q1, q2 * {RESOLUTION!r}) END) AS {k}_least")
            inside.append(f"{share(k)} >= {k}_least")
    return rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
p AS (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS m FROM p), range(8) t(k)
    WHERE m > 1 GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
c AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
s AS (SELECT lang, source, measure, CASE WHEN v > {FLOOR} THEN ceil(round(ln(v / {FLOOR}) / {math.log(GAMMA)!r}, 9))::INT ELSE 0 END AS bucket, count(*) AS n
    FROM ({pairs}) GROUP BY ALL),
{quantiles('o_', 'lang, source')},
{quantiles('l_', 'lang')},
{quantiles('a_', '')},
f AS (SELECT lang, source, {', '.join(bounds)} FROM (SELECT o.lang, o.source, o.measure, {picks} FROM o_ o
    JOIN l_ l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure JOIN a_ a ON o.measure = a.measure) GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce({' AND '.join(inside)}, FALSE) AS kept
FROM c LEFT JOIN f ON c.lang IS NOT DISTINCT FROM f.lang AND c.source IS NOT DISTINCT FROM f.source
"""


OP5_SQL = _sql()
