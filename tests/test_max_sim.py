"""Word-vector search: vectors that words share, texts read once, words against the pattern that they were found by."""

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import ranked as R
from scriptorium.plans import catalogue

from .compare import same
from .test_odd_rows import odd  # noqa: F401


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", [0, 1 << 20])
def test_max_sim_by_slots(spark, monkeypatch, broadcast):
    """Words of one length share a vector; of the query words "absent" is in no item, so it is not asked for."""
    monkeypatch.setattr(R, "BROADCAST_VECTORS", broadcast)
    items = spark.createDataFrame([(0, ["q", "bb"]), (1, ["bb", "bb"]), (2, ["ccc"]), (3, []), (4, None)], "position int, words array<string>")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 0.0]), (6, [0.0, 1.0])], "word int, vector array<float>")
    slot = lambda w: F.length(w)
    found = lambda asked: [(r["position"], round(r["score"], 6)) for r in R.max_sim(items, vectors, asked, slot=slot).collect()]
    assert found(["q", "absent"]) == [(0, 1.0)] and found(["absent"]) == [] and found(["ccc"]) == []
    assert found(["q", "bb"]) == [(0, 1.0)]
    assert [(r["position"], round(r["score"], 6)) for r in R.max_sim(items, vectors.withColumn("word", F.repeat(F.lit("b"), "word")), ["bb"]).collect()] == [(0, 1.0), (1, 1.0)]


def test_max_sim_reads_texts_once(spark, small, monkeypatch):
    """What follows the texts is stored as numbers, so the result's plan reads no text."""
    stored = []
    monkeypatch.setattr(R, "materialise", lambda df, name, keep=R.materialise: stored.append(df) or keep(df, name))
    out = catalogue.QUERIES["maxsim_search"](spark, small)
    assert "documents.parquet" not in plan(out) and sum("documents.parquet" in plan(df) for df in stored) == 1


def test_vocabulary_words_against_the_pattern(spark):
    other = f"[^{T.WHITE_SPACE}\\x{{1C}}-\\x{{1F}}]"
    rng = random.Random(5)
    texts = ["".join(rng.choice(["ab", "word", "x1", "\u00e9", " ", "  ", "\n", "\t", "\u0085", "\u2028", "\u00a0", "\x1c", "\u3000", "\u200b", "z" * 25]) for _ in range(12)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", " ", None, "last\n", "last\u0085"]], "t string")
    old = F.regexp_extract_all("t", F.lit(f"(?<!{other})[a-z]{{4,24}}(?!{other})"), F.lit(0))
    assert df.filter(~old.eqNullSafe(T.vocabulary_words(F.col("t")))).count() == 0


@pytest.mark.parametrize("name", ["maxsim_search"])
def test_odd_rows_equal_sql(spark, odd, name):  # noqa: F811
    same(spark, odd, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])
