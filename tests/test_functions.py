"""Golden cases of the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import marks as M
from scriptorium.functions import text as T
from scriptorium.functions import words as W
from scriptorium.operators import linkage as L
from scriptorium.operators import ordered as O
from scriptorium.operators import ranked as R
from scriptorium.sources import books as B


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [("8.0", 8), ("8.2", 1082), ("1.0", 1), ("x", 0), (None, 0)])
def test_chapter_number(spark, raw, want):
    assert one(spark, raw, M.chapter_number) == want


@pytest.mark.parametrize("raw,want", [("2950", (2950, 0)), ("8a", (8, 1)), (None, (0, 0)), ("x", (0, 0))])
def test_citation_parts(spark, raw, want):
    assert (one(spark, raw, M.citation_base), one(spark, raw, M.citation_suffix)) == want


@pytest.mark.parametrize("word,want", [("controlling", "control"), ("controls", "control"), ("stopped", "stop"), ("falling", "fall"), ("passed", "pass"), ("four", None)])
def test_stem(spark, word, want):
    assert one(spark, word, W.stem) == want


@pytest.mark.parametrize("word,want", [("neighbour", "neighbor"), ("neighbor", "neighbour"), ("four", None), ("hour", None), ("your", None), ("realise", "realize")])
def test_variant(spark, word, want):
    assert one(spark, word, W.variant) == want


def test_bracket_groupings(spark):
    s = "A [one] B [two] C [three] D"
    got = {one(spark, s, lambda c, m=m: T.strip_grouped(T.bracket_segments(c), F.lit(m))) for m in range(4)}
    assert got == {"A  D", "A  B  C  D", "A  B  D", "A  C  D"}
    assert one(spark, s, lambda c: T.provable(c, F.lit("acd"))) and not one(spark, s, lambda c: T.provable(c, F.lit("abx")))
    assert not one(spark, "no brackets", lambda c: T.provable(c, F.lit("nobrackets")))


def test_fingerprint_of_blocked_words(spark):
    from scriptorium.plans.catalogue import BLOCKED

    assert one(spark, "\n".join(sorted(BLOCKED)), T.fnv1a) == "364acd6b07a2588f"
    assert one(spark, "", T.fnv1a) == "cbf29ce484222325"


@pytest.mark.parametrize("grade,name,want", [("Da'if (Darussalam)]", "Darussalam", "Da'if"), ("Da'if, Da'if", "", "Da'if"), ("Sahih, Sahih Hadeeth", "", "Sahih, Sahih Hadeeth"), ("Sahih [ al-Bukhari (6647).", "X", "Sahih [ al-Bukhari (6647)]."), ("Hasan  ,", "", "Hasan  ,")])
def test_grade_repair(spark, grade, name, want):
    assert one(spark, grade, lambda c: M.repair_grade(c, F.lit(name))) == want


def test_grade_parse(spark):
    assert tuple(one(spark, "Grade : Sahih (Darussalam)", M.parse_grade)) == ("Darussalam", "Sahih")
    assert one(spark, "Sahih Muslim 8 a", M.parse_grade) is None and one(spark, None, M.parse_grade) is None


def test_clean_text_guard(spark):
    assert one(spark, " a b ", T.clean_text) == " a b "
    assert one(spark, " a \r\n\r\n b\tc\nd ", T.clean_text) == "a\n\nb c d"


def test_arabic_folds(spark):
    assert one(spark, "أَحْمَدُ", T.fold_arabic) == "احمد"
    assert one(spark, "أَحْمَدُ بْنُ", T.match_fold) == "احمدبن"


def test_positions_with_hot_group(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"), F.col("id"))
    bad = O.positions(df, "g", "id", span=64).groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("row").alias("d"), F.min("row").alias("lo"), F.max("row").alias("hi")).filter("n <> d or lo <> 0 or hi <> n - 1")
    assert bad.isEmpty()


def test_candidate_window_is_bisect(spark):
    import bisect

    donors = [f"k{i:03d}" for i in range(0, 200, 3)]
    targets = [(1, "k000"), (2, "k100"), (3, "zzz"), (4, "a")]
    d = spark.createDataFrame([("b", k) for k in donors], "book string, key string")
    t = spark.createDataFrame([("b", i, k) for i, k in targets], "book string, id long, key string")
    got = {(r["id"], r["donor_rank"]) for r in L.candidate_window(t, d, 4).collect()}
    assert got == {(i, p) for i, k in targets for at in [bisect.bisect_left(donors, k)] for p in range(max(0, at - 4), at + 4)}


def test_repair_by_proof(spark):
    t = spark.createDataFrame([("b", 1, "abcend"), ("b", 2, "nothing")], "book string, id long, key string")
    d = spark.createDataFrame([("b", "abc [x] end"), ("b", "other [y]")], "book string, clean string")
    assert [tuple(r) for r in L.repair_by_proof(t, d).collect()] == [("b", 1, "abc [x] end")]


def test_repair_by_proof_refuses_ambiguity(spark):
    t = spark.createDataFrame([("b", 1, "abcend"), ("b", 2, "nothing"), ("b", 3, "sameend"), ("b", 4, "oneend")], "book string, id long, key string")
    d = spark.createDataFrame([("b", x) for x in ("abc [x] end", "abc [y] end", "same [-] end", "one [z] end", "One [z] end!")], "book string, clean string")
    got = {r["id"]: (r["status"], r["clean"]) for r in L.proof_status(t, d).collect()}
    assert got == {1: ("ambiguous", None), 2: ("unmatched", None), 3: ("unmatched", None), 4: ("repaired", "One [z] end!")}
    assert [tuple(r) for r in L.repair_by_proof(t, d).collect()] == [("b", 4, "One [z] end!")]


def test_lookup_grades_falls_back(spark):
    rows = [(1, "N", "exact"), (2, "N", "damaged end"), (3, "N", "text only"), (4, "N", "two verdicts"), (5, "N", "ambiguous end"), (6, None, " "), (7, "X", "scarred end"), (8, "", "none")]
    entries = [("N exact", [("b", "1"), ("a", "2")]), ("N exact!", [("a", "2")]), ("N damaged [x] end", [("c", "3")]), ("N damaged [x] end.", [("d", "9")]), ("text only", [("e", "4")])]
    entries += [("N two verdicts", [("f", "5")]), ("N two verdicts", [("f", "6")]), ("N ambiguous [x] end", [("g", "7")]), ("N ambiguous [y] end", [("g", "7")]), ("scarred [z] end", [("h", "8")])]
    r = spark.createDataFrame([("b", *x) for x in rows], "book string, id long, narrator string, text string")
    e = spark.createDataFrame([("b", i, *x) for i, x in enumerate(entries)], "book string, ord long, text string, grades array<struct<name string, grade string>>")
    got = {x["id"]: x["grades"] and [tuple(g) for g in x["grades"]] for x in L.lookup_grades(r, e).collect()}
    assert got == {1: [("a", "2"), ("b", "1")], 2: [("c", "3")], 3: [("e", "4")], 4: None, 5: None, 6: None, 7: [("h", "8")], 8: None}


def test_empty_query_and_max_sim(spark):
    assert R.parse(spark, " a ") is None
    items = spark.createDataFrame([(0, ["a", "b"]), (1, ["c"]), (2, [])], "position int, words array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [0.6, 0.8]), ("q", [2.0, 0.0])], "word string, vector array<float>")
    assert [(r["position"], round(r["score"], 6)) for r in R.max_sim(items, vectors, ["q", "unknown"]).collect()] == [(0, 1.0)]


def test_book_files(spark, tmp_path):
    book = {"id": 1, "metadata": {"id": 1, "length": 2}, "chapters": [{"id": 8.2, "bookId": 1, "arabic": "a", "english": "e"}], "hadiths": [{"id": 1, "idInBook": 1, "chapterId": 8.2, "bookId": 1, "citation": "8a", "arabic": "x", "english": {"narrator": "n", "text": "t"}}, {"id": 2, "idInBook": 2, "chapterId": 1, "bookId": 1, "arabic": "y", "english": {"narrator": "", "text": ""}}]}
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "demo.json").write_text(json.dumps(book))
    r = B.records(B.read_books(spark, str(tmp_path), ["demo"])).orderBy("row").collect()
    assert [(x["row"], x["chapter"], x["citation_base"], x["citation_suffix"], x["citation"]) for x in r] == [(0, 1082, 8, 1, "8a"), (1, 1, 0, 0, None)]
    B.write_pack(B.records(B.read_books(spark, str(tmp_path))), str(tmp_path / "pack"), 2)
    assert B.chapter_slice(spark.read.parquet(str(tmp_path / "pack")), "demo", 1, 1).count() == 1
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "2 x.json").write_text("﻿" + json.dumps([{"english": "e", "arabic": "a", "reference": "r", "grade": "Grade : Hasan (Nn)"}], indent=1))
    x = B.read_donor_b(spark, str(tmp_path / "b")).first()
    assert (x["file_number"], x["english"], x["parsed_grade"]["grade"]) == (2, "e", "Hasan")


def test_stream_fold(spark, tmp_path):
    from scriptorium.streaming.folds import scanned_stream

    src = tmp_path / "in"
    spark.createDataFrame([("Hello, World",), ("other",)], "text string").write.parquet(str(src))
    q = scanned_stream(spark.readStream.schema("text string").parquet(str(src)), "hello world").writeStream.format("memory").queryName("folded").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r["body_fold"] for r in spark.table("folded").collect()] == ["hello world"]
