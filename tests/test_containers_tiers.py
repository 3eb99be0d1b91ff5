"""Container round trips and alignment tiers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import ordered as O
from scriptorium.operators import tiers as Z
from scriptorium.sources import containers as C


def test_pack_round_trip(spark, tmp_path):
    n = 300
    rows = spark.range(n).select(
        F.lit("demo").alias("slug"), F.col("id").alias("row"), (F.col("id") + 10).alias("id"), (F.col("id") + 1).alias("id_in_book"),
        F.when(F.col("id") < 100, 1).otherwise(1082).alias("chapter"), (F.col("id") % 7).alias("citation_base"), (F.col("id") % 3).alias("citation_suffix"), (F.col("id") % 4).alias("flags"),
        F.concat(F.lit("ع"), F.col("id").cast("string")).alias("arabic"), F.when(F.col("id") % 5 != 0, F.lit("n")).alias("narrator"), F.repeat(F.lit("long text "), F.col("id").cast("int")).alias("text"), F.lit("").alias("grades"),
    ).withColumns({"arabic_fold": T.fold_arabic(F.col("arabic")), "english_fold": T.fold_english(F.col("text"))})
    chapters = spark.createDataFrame([("demo", 1, 0, 100, "a", "e", "fa", "fe"), ("demo", 1082, 100, 200, "b", "f", "fb", "ff")], C.CHAPTER_SCHEMA)
    titles = spark.createDataFrame([("demo", "t1", "t2", "t3", "t4")], "slug string, arabic_title string, arabic_author string, english_title string, english_author string")
    files = C.pack_files(rows, chapters, titles, block_bytes=20_000, fold_print="00ff")
    C.write_files(files, str(tmp_path), ".hpk").collect()
    got = C.read_packs(spark, str(tmp_path)).orderBy("row").collect()
    want = rows.orderBy("row").collect()
    assert len(got) == n and len({r["block"] for r in got}) > 5
    for g, w in zip(got, want):
        base, suffix = w["citation_base"], w["citation_suffix"]
        assert g["citation"] == (f"{base}{['', 'a', 'b'][suffix]}" if base else None)
        assert [g[c] for c in ("row", "id", "id_in_book", "chapter", "flags", "arabic", "text")] == [w[c] for c in ("row", "id", "id_in_book", "chapter", "flags", "arabic", "text")]
        assert g["narrator"] == (w["narrator"] or "")
    folds = {r["row"]: (r["arabic_fold"], r["english_fold"]) for r in C.read_pack_folds(spark, str(tmp_path)).collect()}
    assert folds == {w["row"]: (w["arabic_fold"], w["english_fold"]) for w in want}
    assert sorted(map(tuple, C.read_pack_chapters(spark, str(tmp_path)).collect())) == sorted(map(tuple, chapters.collect()))
    assert C.read_pack_titles(spark, str(tmp_path)).first()["fold_print"] == "00000000000000ff"
    data = (tmp_path / "demo.hpk").read_bytes()
    for bad in (data[:40], b"xxxx" + data[4:], data[: len(data) // 2]):
        with pytest.raises(ValueError):
            p = C._open_pack(bad, "bad")
            for b in p["blocks"]:
                C._inflate(bad[b["text_at"] : b["text_at"] + b["text_len"]], int(b["text_raw"]), "bad")


def test_encyclopedia_round_trip(spark, tmp_path):
    tree = [["1", "", "Root", "جذر", "0", "3"], ["2", "1", "Leaf", "ورقة", "3", "3"]]
    entries = [[str(i), "1,2" if i % 2 else ""] + [f"f{i}.{k}" for k in range(15)] for i in range(300)]
    for e in entries:
        e[6] = "b1\x1fb2"
    (tmp_path / "all.henc").write_bytes(C.henc_content(tree, entries))
    full = C.read_entries(spark, str(tmp_path)).orderBy("position").collect()
    assert len(full) == 300 and full[129]["ar_benefits"] == ["b1", "b2"] and full[129]["categories"] == ["1", "2"] and full[128]["categories"] == []
    assert full[299]["en_grade"] == "f299.14"
    light = C.read_entries(spark, str(tmp_path), "light").orderBy("position").collect()
    assert (light[7]["title"], light[7]["grade"], light[7]["attribution"]) == (full[7]["en_title"], full[7]["en_grade"], full[7]["en_attribution"])
    assert [(r["id"], r["parent"], r["total"]) for r in C.read_entries(spark, str(tmp_path), "tree").orderBy("position").collect()] == [("1", None, 3), ("2", "1", 3)]


def test_vectors_round_trip(spark, tmp_path):
    v = {"a": [3.0, 4.0], "b": [0.0, 2.0]}
    (tmp_path / "w.svec").write_bytes(C.svec_content(v, [["a", "b"], [], ["b"]], ["k0", "k1", "k2"], 7, "print"))
    got = {r["word"]: r["vector"] for r in C.read_vectors(spark, str(tmp_path), 7, "print").collect()}
    assert np.allclose(got["a"], [0.6, 0.8], atol=1e-3) and got["b"] == [0.0, 1.0]
    assert [(r["position"], r["key"], r["words"]) for r in C.read_vector_items(spark, str(tmp_path)).collect()] == [(0, "k0", ["a", "b"]), (1, "k1", []), (2, "k2", ["b"])]
    with pytest.raises(Exception, match="build it again"):
        C.read_vectors(spark, str(tmp_path), 8).collect()


def test_blocks_stream(spark):
    rows = spark.range(5000).select((F.col("id") % 3).cast("string").alias("book"), F.floor(F.col("id") / 3).alias("row"), (F.col("id") * 7919 % 400).alias("bytes"))
    want = {}
    state = {}
    for r in rows.orderBy("row").collect():
        held, block = state.get(r["book"], (0, 0))
        want[r["book"], r["row"]] = block
        held += r["bytes"]
        state[r["book"]] = (0, block + 1) if held >= 3000 else (held, block)
    assert {(r["book"], r["row"]): r["block"] for r in O.block_assignment(rows, 3000).collect()} == want


def test_tiers(spark):
    """Rows 0 to 39 against donors shifted by 2: equal folds, one row by translation, one by proof, a gap, a prefix."""
    fold = lambda i: f"{'ab' * 30}{i:03d}{'cd' * 5}"
    rows = [["b", i, fold(i), "", f"text number {i} of the book"] for i in range(40)]
    donors = [["b", i, fold(i - 2), f"text number {i - 2} of the book"] for i in range(44)]
    rows[10][2] = "x1"  # equal translation
    rows[20][2] = "x2"
    rows[20][4] = "text of the book"
    donors[22][3] = "text [number 20] of the book"  # proved translation
    rows[30][2], rows[30][4] = "x3", ""  # position
    unlike = "q" * 60
    rows[39][2], rows[39][4] = unlike + "one", ""
    donors[43][2], donors[43][3] = unlike + "two", ""  # prefix
    r = spark.createDataFrame([tuple(x) for x in rows], "book string, row long, fold string, narrator string, text string")
    d = spark.createDataFrame([tuple(x) for x in donors], "book string, donor long, fold string, english string")
    got = {x["row"]: (x["donor"], x["tier"]) for x in Z.aligned(r, d).collect()}
    assert len(got) == 40
    assert got[0] == (2, "T1") and got[10] == (12, "T3") and got[20] == (22, "T3") and got[30] == (32, "T4") and got[39] == (43, "T5")
    checked = Z.cross_checked(r, d.select("book", F.concat("english", F.lit(" " + "z" * 40)).alias("text"), F.col("donor").alias("number")))
    assert checked.count() == 0
    long_rows = r.withColumn("text", F.concat("text", F.lit("z" * 40)))
    assert Z.cross_checked(long_rows, long_rows.select("book", "text", F.col("row").alias("number"))).filter("row = number").count() > 30


def test_greedy_choices():
    import pandas as pd

    p = pd.DataFrame([("b", 1, 0, False, 7, 1), ("b", 2, 0, False, 7, 1), ("b", 2, 1, True, 9, 1), ("b", 3, 0, False, 5, 2), ("b", 3, 1, False, 6, 1)], columns=["book", "row", "k", "proof", "donor", "n"])
    assert Z.choose_translations(p)[["row", "donor"]].values.tolist() == [[1, 7], [2, 9]]
    q = pd.DataFrame([("b", 1, 4, 3, 6, 0), ("b", 2, 4, 3, 6, 0), ("b", 2, 5, 3, 6, 0), ("b", 3, 4, 3, 6, 0)], columns=["book", "row", "donor", "lo", "hi", "gap"])
    assert Z.choose_prefixes(q)[["row", "donor"]].values.tolist() == [[1, 4], [2, 5]]
