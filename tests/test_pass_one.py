"""Repairs by key: each row is matched once, by digests, and the match is the proof."""

import sys

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import boundary as B
from scriptorium.operators import linkage as L
from scriptorium.operators import repair as P
from scriptorium.plans import catalogue

from .compare import same
from .test_odd_rows import odd  # noqa: F401
from .test_max_sim import plan


def test_pass_one_matches_each_row_once(spark):
    """Rows that share (book, id), or have no book, are counted as often as they are there."""
    rows = [("b", 1, "S", "one end"), ("b", 1, "S", "other"), ("b", 1, "S", "one end"), (None, 1, "S", "one end"), ("b", 3, "S", None)]
    donors = [("b", 1, "S one [y] end"), ("b", None, "S one [z] end"), (None, 1, "S one [x] end"), ("b", None, "S other"), ("b", 2, None), ("b", 0, "S [x]")]
    out = P.pass_one(spark.createDataFrame(rows, "book string, id long, narrator string, body string"), spark.createDataFrame(donors, "book string, ord int, body string"))
    got = sorted((str(r["book"]), r["status"], r["body"], r["before"]) for r in out.collect())
    assert got == [("None", "unmatched", "one end", None), ("b", "repaired", "one [y] end", "one end"), ("b", "repaired", "one [y] end", "one end"), ("b", "unchanged", "other", None), ("b", "unmatched", "", None)]
    assert sorted((str(r["book"]), r["total"], r["repaired"]) for r in P.pass_one_stats(out).collect()) == [("None", 1, 0), ("b", 4, 2)]
    assert "Python" not in plan(P.pass_one_stats(out))  # statuses need no text


def test_repair_by_key_moves_digests(spark):
    """Where only the status is read, no shuffle holds a text."""
    text = " ".join(f"w{j}" for j in range(400))
    rows = spark.createDataFrame([(i, f"{text} {i}") for i in range(9)], "id long, body string")
    donors = spark.createDataFrame([(0, f"{text} [x] {i}") for i in range(9)], "ord int, body string")
    found = L.repair_by_key(rows, donors)
    assert {r["repaired"] for r in found.collect()} == {f"{text} [x] {i}" for i in range(9)}
    shuffled = [line for line in plan(found.groupBy("status").count()).split("\n") if "partial_m" in line]
    assert shuffled and not any("min(clean#" in line for line in shuffled)


def i_ascii(c: str) -> bool:
    return any(x.isascii() for x in c.upper() + c.casefold())


def test_a_match_of_keys_is_the_proof_of_deletion(spark):
    """The engine's key and stripped text are those with which a restored text is proved."""
    texts = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    texts = [f"a{c}b" for c in texts if c.lower() != c or not c.isalnum() or i_ascii(c)] + ["a [b\nc] d", "a [b\rc] d", "a [b\u2028c\u0085] d", "[[a] b] c", "Chapter Mayallah be pleased with him versesaw", "\u0130I\u0131"]
    df = spark.createDataFrame([(t, B._key(B._LINE_SPAN.sub("", t))) for t in texts], "t string, want string")
    assert df.filter(~T.norm_key(T.greedy_strip(F.col("t"))).eqNullSafe(F.col("want"))).count() == 0


@pytest.mark.parametrize("name", ["repair_pass1", "repair_report", "repair_log"])
def test_odd_rows_equal_sql(spark, odd, name):  # noqa: F811
    same(spark, odd, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])
