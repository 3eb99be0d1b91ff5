"""Letters, names, split search."""

import itertools

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import letters as A
from scriptorium.operators import boundary as S

from .test_functions import one


def test_respelling(spark):
    assert len(A.spellings()) == 61
    assert one(spark, "x عَلَی فِی y", A.respell) == "x عَلَى فِي y"
    df = spark.createDataFrame([("فِي فِي",), ("فِى",), (None,), ("",)], "t string")
    got = {r["word"]: (r["expected"], r["best"], r["n"]) for r in A.spelling_report(df, "t").collect()}
    assert got["فِی"] == ("فِي", "فِي", 2) and got["کَادَ"][1:] == (None, 0) and len(got) == 61


def test_skeleton_and_literals(spark):
    assert one(spark, "مُحَمَّدْ", A.skeleton) == "محمد" and one(spark, None, A.skeleton) is None
    assert one(spark, "آ", A.skeleton) == "آ"  # composed first
    assert one(spark, r"a\n\"b\" \\n \u{41}\q", A.unescape) == 'a\n"b" \\n A\\q' and one(spark, None, A.unescape) is None


def test_catalogue_changes(spark):
    schema = "slug string, title string, note string, aliases array<string>"
    ours = spark.createDataFrame([("a", "محمد", "old", ["x"]), ("b", "محمد", "n", ["x"]), ("c", "محمد", "n", ["x"]), ("d", "t", "n", ["x"])], schema)
    theirs = spark.createDataFrame([("a", "مُحَمد", "new", ["x"]), ("b", "محمود", "n", ["y"]), ("c", "محمدْ", "n", ["x"])], schema)
    got = {(r["slug"], r["field"]): r["verdict"] for r in A.catalogue_changes(ours, theirs, "slug", ["title", "note", "aliases"], ["aliases"]).collect()}
    assert got == {("a", "title"): "marks", ("a", "note"): "plain", ("b", "title"): "letters", ("b", "aliases"): "list", ("c", "title"): "sukoon", ("d", "title"): "missing", ("d", "note"): "missing", ("d", "aliases"): "missing"}
    with pytest.raises(ValueError):
        A.synchronised(ours, theirs, "slug", ["title", "note"], [])
    one_row = A.synchronised(ours.filter("slug = 'a'"), theirs.filter("slug = 'a'"), "slug", ["title", "note"], []).first()
    assert tuple(one_row)[:3] == ("a", "مُحَمد", "new")


def test_reference_names(spark):
    books = spark.createDataFrame([("nasai", ["nasai", "annasai"]), ("qudsi", ["qudsi"]), ("ibnmajah", ["ibnmajah"]), ("p", ["twin"]), ("q", ["twin"])], "slug string, aliases array<string>")
    refs = [(1, "Sunan an-Nasa'i 5"), (2, "Hadith 24"), (3, "Qudsi 24a"), (4, "twin 3"), (5, "nasai qudsi 1"), (6, None), (7, ""), (8, "Ibn Majah"), (9, "Qudsi 24a")]
    got = sorted(tuple(r) for r in A.resolve_references(spark.createDataFrame(refs, "i long, t string"), "i", "t", books).collect())
    assert got == [(1, "nasai", "5"), (3, "qudsi", "24a"), (8, "ibnmajah", None), (9, "qudsi", "24a")]


def test_estimate_is_brute_force():
    for clean in ["Narrated A. (PBUH): he said", "", "saw saw x", "pb uh ab", "Ümlaut ab"]:
        for narrator in ["Narrated A", "", "ab", "he", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz"]:
            want = len(S._key(narrator))
            brute = next((i for i in range(1, len(clean) + 1) if len(S._key(clean[:i])) >= want), 0) if want else 0
            assert S.estimate(clean, narrator) == brute


def test_proof_is_every_grouping():
    clean = "ab [x] cd [y] ef [z] gh"
    parts = ["ab ", " cd ", " ef ", " gh"]
    for keep in itertools.product([0, 1], repeat=2):
        target = S._key(parts[0] + "".join(p for p, k in zip(parts[1:3], keep) if k) + parts[3])
        assert S._proof("grouping", target)(clean)
    assert not S._proof("grouping", "abgx")(clean) and not S._proof("grouping", "abcd")("ab cd")


def test_divide(spark):
    assert S.divide("Narrated Ali: He [the man] said it.", "Narrated Ali:", "He said it.", "deletion") == ("Narrated Ali:", "He [the man] said it.", False)
    assert S.divide("Narrated Ali (RAA): He [a] went [b] home", "Narrated Ali (RAA)", "He went home", "grouping") == ("Narrated Ali (RAA)", "He [a] went [b] home", False)
    assert S.divide("He [a] said", "", "He said", "grouping") == ("", "He [a] said", False)
    assert S.divide("Other words [x]", "Narrated", "He said", "grouping") == (None, None, None)
    # no cut keeps the proof: the narrator is folded into the body
    assert S.divide("[From] Alone here", "Alo", "ne here", "deletion")[0] in ("Alo", "")
    rows = spark.createDataFrame([(1, "Narrated Ali:", "He said it."), (2, "N", "b"), (3, None, None)], "id long, narrator string, body string")
    matches = spark.createDataFrame([(1, "Narrated Ali: He [the man] said it."), (2, "other")], "id long, clean string")
    got = [(r["id"], r["body"], r["before"], r["status"]) for r in S.restore_rows(rows, matches, "deletion").orderBy("id").collect()]
    assert got == [(1, "He [the man] said it.", "He said it.", "repaired"), (2, "b", None, "unprovable"), (3, None, None, "untouched")]
    trimmed = S.trim_logged(spark.createDataFrame([(1, "): a"), (2, "): b")], "id long, body string"), spark.createDataFrame([(1,), (1,)], "id long"))
    assert sorted(tuple(r) for r in trimmed.collect()) == [(1, "a"), (2, "): b")]
