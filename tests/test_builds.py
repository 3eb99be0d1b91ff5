"""Composed repairs, derived corpora, gates and readers on small cases; ordered operators against plain loops."""

import json
import random

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import trees as Y
from scriptorium.operators import boundary as B
from scriptorium.operators import builds as D
from scriptorium.operators import linkage as L
from scriptorium.operators import ordered as O
from scriptorium.operators import repair as P
from scriptorium.operators import tiers as Z
from scriptorium.sources import books as S


def test_pass_one_restores_and_counts(spark):
    rows = [("b", 1, "By A:", "He said  ."), ("b", 2, "By A:", "Same text"), ("b", 3, "By A:", "None has  this"), ("b", 4, "By A:", "Two of it"), ("c", 1, "By A:", "He said  .")]
    donors = [("b", 1, "By A: He said [to them] ."), ("b", 1, "By A: Same text"), ("b", 1, "By A: Two [one] of it"), ("b", 1, "By A: Two [other] of it"), ("c", 2, "By A: He said [it] .")]
    out = P.pass_one(spark.createDataFrame(rows, "book string, id long, narrator string, body string"), spark.createDataFrame(donors, "book string, ord int, body string"))
    got = {(r["book"], r["id"]): r for r in out.collect()}
    assert {k: r["status"] for k, r in got.items()} == {("b", 1): "repaired", ("b", 2): "unchanged", ("b", 3): "unmatched", ("b", 4): "ambiguous", ("c", 1): "repaired"}
    assert (got["b", 1]["narrator"], got["b", 1]["body"], got["b", 1]["before"]) == ("By A:", "He said [to them] .", "He said  .") and got["c", 1]["body"] == "He said [it] ."
    stats = {r["book"]: r.asDict() for r in P.pass_one_stats(out).collect()}
    assert stats["b"] == {"book": "b", "total": 4, "damaged": 1, "repaired": 1, "ambiguous": 1, "unmatched_scarred": 1, "unprovable": 0}
    log = P.log_entries(out).collect()
    assert sorted((r["book"], r["id"], r["before"], r["after"], r["narrator_folded"], r["pass"]) for r in log) == [("b", 1, "He said  .", "He said [to them] .", False, None), ("c", 1, "He said  .", "He said [it] .", False, None)]


def test_pass_two_agrees_refuses_and_skips(spark):
    rows = [("b", i, "S", f"{w} end") for i, w in enumerate(["one", "two", "three", "four", "five  and"])]
    donors = [("b", 0, "S one [x] end"), ("b", 1, "S one [x] end"), ("b", 0, "S two [x] end"), ("b", 1, "S two [y] end"), ("b", 1, "S three [x] end"), ("b", 0, "S four [x] end")]
    log = spark.createDataFrame([("b", 3)], "book string, id long")
    out = P.pass_two(spark.createDataFrame(rows, "book string, id long, narrator string, body string"), spark.createDataFrame(donors, "book string, ord int, clean string"), log)
    got = {r["id"]: (r["status"], r["body"], r["confirmed_by"]) for r in out.collect()}
    assert got == {0: ("repaired", "one [x] end", 2), 1: ("ambiguous", "two end", None), 2: ("repaired", "three [x] end", 1), 3: ("logged", "four end", None), 4: ("unmatched", "five  and end", None)}
    assert P.pass_two_stats(out).collect()[0].asDict() == {"book": "b", "total": 5, "repaired": 2, "one_donor": 1, "ambiguous": 1, "scarred_left": 1}
    new = P.log_entries(out, "line_aware").withColumn("after", F.concat(F.lit(": "), "after"))
    old = new.filter("id = 0").withColumn("after", F.lit("kept"))
    merged = P.merged_log(old, P.trimmed_log(new)).collect()
    assert sorted((r["id"], r["after"], r["confirmed_by"], r["pass"]) for r in merged) == [(0, "kept", 2, "line_aware"), (2, "three [x] end", 1, "line_aware")]


def test_trimmed_bodies_are_never_emptied(spark):
    rows = spark.createDataFrame([(1, ": a"), (2, ": b"), (3, ":.")], "id long, body string")
    assert sorted(tuple(r) for r in B.trim_logged(rows, spark.createDataFrame([(1,), (3,), (3,)], "id long")).collect()) == [(1, "a"), (2, ": b"), (3, ":.")]


def test_gates_raise(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string")
    D.gate(a, a, ["id"])
    for b in ([(1, "x")], [(1, "x"), (2, "z")], [(1, "x"), (2, "y"), (2, "y")]):
        with pytest.raises(ValueError):
            D.gate(a, spark.createDataFrame(b, "id int, t string"), ["id"])
    D.shape_gate(a.agg(F.count("*").alias("n")), {"n": 2})
    with pytest.raises(ValueError, match="n 3 2"):
        D.shape_gate(a.agg(F.count("*").alias("n")), {"n": 3})
    twice = spark.createDataFrame([("a", None), ("a", None), (None, None), ("b", "c")], "p string, q string")
    assert [tuple(r) for r in L.repeated_keys(twice, ["p", "q"]).collect()] == [("a", None, 2)]


def test_topics_fail_on_a_duplicate(spark):
    raw = spark.createDataFrame([("ab-1", None, "t", "l", 2), ("x", "https://sunnah.com/ab:1", "t", "l", 1)], "id string, reference string, topic string, lane string, rank int")
    records = spark.createDataFrame([("ab", "1", None)], "slug string, citation string, grades array<struct<name:string,grade:string>>")
    ids = lambda x: spark.createDataFrame([(x,)], "id string")
    with pytest.raises(ValueError, match="duplicate"):
        D.build_topics(raw, records, ids("l"), ids("t"), ["ab"])
    assert [(r["id"], r["slug"], r["citation"], r["graded"]) for r in D.build_topics(raw.limit(1), records, ids("l"), ids("t"), ["ab"]).collect()] == [("ab-1", "ab", "1", False)]


def test_encyclopedia_from_files(spark, tmp_path):
    entry = {"title": " T\r\n", "intro": "", "body": "a\rb ", "explanation": "", "benefits": [" x "], "attribution": "", "grade": ""}
    (tmp_path / "core.json").write_text(json.dumps({"10": entry | {"words": [{"w": " w", "m": "m"}], "reference": ""}, "9": entry | {"words": [], "reference": "r"}, "3": entry}))
    (tmp_path / "tr-en.json").write_text(json.dumps({"10": entry, "9": entry}))
    (tmp_path / "catalog.json").write_text(json.dumps({"tree": [{"id": "1", "labels": {"en": "E", "ar": "A"}}, {"id": "2", "parent": "1", "labels": {}}], "index": [{"id": "10", "cats": ["2", "7"]}]}))
    core, english, tree, index = (S.read_encyclopedia(spark, str(tmp_path), n) for n in ("core", "tr-en", "tree", "index"))
    out = D.encyclopedia(core, english, index).orderBy(D.numeric(F.col("id"))).collect()
    assert [(r["id"], r["categories"], r["arabic"]["title"], r["arabic"]["body"], r["english"]["benefits"]) for r in out] == [("9", [], "T", "a\nb", ["x"]), ("10", ["2", "7"], "T", "a\nb", ["x"])]
    assert out[1]["arabic"]["words"][0]["w"] == "w" and [tuple(r) for r in D.orphan_parents(tree).collect()] == []
    with pytest.raises(ValueError, match="'7'"):
        D.checked_encyclopedia(core, english, index, tree)
    leaves = tree.select(Y.string_leaves(F.struct(*tree.columns), tree.select(F.struct(*tree.columns).alias("s")).schema["s"].dataType).alias("x")).collect()
    assert [r["x"] for r in leaves] == [["1", "E", "A"], ["2", "1"]]
    (tmp_path / "manifest.json").write_text(json.dumps({"formatVersion": 3, "books": [{"slug": "a", "bytes": 5}, {"slug": "b"}]}))
    assert [(r["formatVersion"], r["slug"], r["bytes"]) for r in S.read_manifest(spark, str(tmp_path / "manifest.json")).collect()] == [(3, "a", 5), (3, "b", None)]
    assert S.read_vectors(spark, str(tmp_path / "manifest.json")).select(F.variant_get("vectors", "$.books[1].slug", "string")).first()[0] == "b"


def test_donor_files_in_book_order(spark, tmp_path):
    rows = lambda *x: "﻿" + json.dumps([{"english": e, "reference": "", "grade": "Grade : Sahih (Nn)"} for e in x])
    for name, text in (("10_b.json", rows("d")), ("2_a.json", rows("b", "c")), ("intro.json", rows("a")), ("3_bad.json", "[{")):
        (tmp_path / name).write_text(text)
    got = S.read_donor_b(spark, str(tmp_path))
    assert [(r["row"], r["english"], r["parsed_grade"]["name"]) for r in got.filter("corrupt is null").orderBy("row").collect()] == [(0, "a", "Nn"), (1, "b", "Nn"), (2, "c", "Nn"), (3, "d", "Nn")]
    assert [(r["file"], r["corrupt"]) for r in got.filter("corrupt is not null").collect()] == [("3_bad.json", "[{")]
    assert S.read_donor_b(spark, str(tmp_path), only="2_a.json").count() == 2


def test_logs_and_corpora_are_written_in_order(spark, tmp_path):
    log = spark.createDataFrame([("a", i, f"t{i}") for i in (5, 3, 9)] + [("b", 1, "u")], "slug string, idInBook long, after string")
    S.write_log(log, f"{tmp_path}/log")
    assert [json.loads(r["value"])["idInBook"] for r in spark.read.text(f"{tmp_path}/log/slug=a").collect()] == [3, 5, 9]
    S.write_corpora(f"{tmp_path}/c", words=spark.createDataFrame([("b",), ("a",), ("b",)], "word string"), topics=log)
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/c/vocabulary").collect()] == ["a", "b"] and spark.read.json(f"{tmp_path}/c/topics").count() == 4


def test_trees_of_any_depth_and_cycles(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else None) for i in range(12)], "node string, parent string")
    assert L.descendants(spark, chain).count() == 12 * 13 // 2
    assert L.tree_stats(spark, chain).filter("root = 'n0'").count() == 12
    with pytest.raises(ValueError, match="cycle"):
        L.descendants(spark, spark.createDataFrame([("a", "b"), ("b", "a")], "node string, parent string"))


def test_ranges_change_nothing(spark):
    """Neighbours, islands, places and running counts over ranges of any size, against plain loops."""
    r = random.Random(7)
    rows = sorted({(r.choice("xyz"), r.randrange(60)): r.choice([None, r.randrange(9)]) for _ in range(120)}.items())
    df = spark.createDataFrame([(g, o, v) for (g, o), v in rows], "g string, o long, v long")
    of = lambda g: [(o, v) for (h, o), v in rows if h == g]
    for span in (1, 7, 1000):
        near = {(x["g"], x["o"]): (x["lo"], x["hi"]) for x in O.with_neighbours(df, "g", "o", {"lo": "v"}, {"hi": "v"}, span=span).collect()}
        place = {(x["g"], x["o"]): x["row"] for x in O.positions(df, "g", "o", span=span).collect()}
        island = {(x["g"], x["o"]): x["island"] for x in O.islands(df, "g", "o", F.col("v").isNull(), span=span).collect()}
        down = {x["g"]: (x["n_rows"], x["descents"]) for x in O.descents(df.filter("v is not null"), "g", "o", "v", span=span).collect()}
        for g in "xyz":
            own = of(g)
            for i, (o, _) in enumerate(own):
                before = [v for _, v in own[:i] if v is not None]
                after = [v for _, v in own[i + 1 :] if v is not None]
                assert near[g, o] == (before[-1] if before else None, after[0] if after else None)
                assert place[g, o] == i and island[g, o] == sum(v is None for _, v in own[: i + 1])
            known = [v for _, v in own if v is not None]
            assert down[g] == (len(known), sum(b < a for a, b in zip(known, known[1:])))
    keys = [(r.choice("xy"), "".join(r.choice("ab") for _ in range(r.randrange(5)))) for _ in range(300)]
    got = O.running_count(spark.createDataFrame(keys, "g string, k string").withColumn("one", F.col("k") != ""), "g", "k", F.col("one"), "n").collect()
    for g in "xy":
        assert sorted(x["n"] for x in got if x["g"] == g and x["k"]) == list(range(1, 1 + sum(a == g and k != "" for a, k in keys)))
        assert all(sum(a == g and "" < k < x["k"] for a, k in keys) < x["n"] <= sum(a == g and "" < k <= x["k"] for a, k in keys) for x in got if x["g"] == g and x["k"])


def plain_tiers(rows, donors):
    """All tiers of one book, row by row. rows: (row, fold, text); donors: (donor, fold, english); no brackets in english."""
    import re

    key = lambda s: re.sub("[^a-z0-9]", "", s.lower())
    got = {}
    for fold in {f for _, f, _ in rows if f}:
        a, b = [r for r, f, _ in rows if f == fold], [d for d, f, _ in donors if f == fold]
        if len(a) == len(b):
            got |= {r: (d, "T1" if len(a) == 1 else "T2") for r, d in zip(a, b)}
    taken = {d for d, _ in got.values()}
    open_donors = [(d, e) for d, _, e in donors if d not in taken and e.strip()]
    used = set()
    for r, _, t in rows:
        if r not in got and t.strip():
            same = [d for d, e in open_donors if key(e) == key(t)]
            if len(same) == 1 and same[0] not in used:
                got[r] = (same[0], "T3")
                used.add(same[0])
    steady, run = {}, []
    for r in sorted(got):
        if run and not (r - run[-1] <= 4 and 1 <= got[r][0] - got[run[-1]][0] <= 4):
            steady |= {x: got[x] for x in run} if len(run) >= 5 else {}
            run = []
        run.append(r)
    steady |= {x: got[x] for x in run} if len(run) >= 5 else {}
    if not steady:
        return {}
    last_row, last_donor = max(r for r, _, _ in rows), max(d for d, _, _ in donors)
    anchors = [(-1, -1), *sorted((r, d) for r, (d, _) in steady.items()), (last_row + 1, last_donor + 1)]
    taken, placed = {d for d, _ in steady.values()}, dict(steady)
    for (r0, d0), (r1, d1) in zip(anchors, anchors[1:]):
        span = range(d0 + 1, d1)
        if r1 - r0 > 1 and r1 - r0 == d1 - d0 and not taken & set(span):
            placed |= {r0 + 1 + i: (d, "T4") for i, d in enumerate(span)}
            taken |= set(span)
    done = dict(placed)
    for r, f, _ in rows:
        if r not in done and len(f) >= 48:
            lo = max((d for x, (d, _) in done.items() if x < r and x in placed or x < r and done[x][1] == "T5"), default=-1, key=lambda d: d)
            lo = next((done[x][0] for x in sorted(done, reverse=True) if x < r), -1)
            hi = next((placed[x][0] for x in sorted(placed) if x > r), last_donor + 1)
            free = [d for d, g, _ in donors if lo < d < hi and d not in taken and len(g[:48]) >= 24 and f[:48].startswith(g[:48])]
            if len(free) == 1:
                done[r] = (free[0], "T5")
                taken.add(free[0])
    return done


@pytest.mark.parametrize("seed", range(4))
def test_tiers_against_plain_loops(spark, seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    folds = [word(60) for _ in range(70)]
    rows = [(i, folds[i] if i % 17 else folds[0], f"text {i} of the book") for i in range(70)]
    donors, d = [], 0
    for i, f, t in rows:
        kind = r.random()
        if kind < 0.12:
            continue
        fold, english = f, t
        if kind < 0.24:
            fold = word(50)  # only the translation is equal
        elif kind < 0.34:
            fold, english = f[: r.choice([30, 55])] if r.random() < 0.8 else f[:10], ""  # only a prefix, or nothing
        elif kind < 0.4:
            fold, english = word(50), ""
        donors.append((d, fold, english))
        d += 1
    a = spark.createDataFrame([("b", i, f, "", t) for i, f, t in rows], "book string, row long, fold string, narrator string, text string")
    b = spark.createDataFrame([("b", i, f, e) for i, f, e in donors], "book string, donor long, fold string, english string")
    got = {x["row"]: (x["donor"], x["tier"]) for x in Z.aligned(a, b).collect()}
    want = plain_tiers(rows, donors)
    assert {k: v for k, v in got.items() if v[1]} == want and len(got) == 70
    counts = Z.tier_counts(spark.createDataFrame([("b", *v) for v in got.values()], "book string, donor long, tier string")).first()
    assert counts["n_rows"] == 70 and counts["unmatched"] == 70 - len(want) and counts["t1"] == sum(t == "T1" for _, t in want.values())


def test_encyclopedias_are_written_by_slug(spark, tmp_path):
    from scriptorium.sources import containers as C

    lists = lambda c: f"{c} array<string>" if c in C.LISTS else f"{c} string"
    row = lambda p, slug: (slug, p, *([f"x{p}", "y"] if c in C.LISTS else f"{c} {p}" for c in C.FULL))
    rows = [row(p, s) for s in ("a", "b") for p in range(300)]
    entries = spark.createDataFrame(rows, "slug string, position long, " + ", ".join(map(lists, C.FULL)))
    nodes = [(s, i, f"{i}", None if not i else "0", "en", "ar", i, 2 * i) for s in ("a", "b") for i in range(3)]
    tree = spark.createDataFrame(nodes, "slug string, position long, id string, parent string, en string, ar string, direct long, total long")
    made = C.write_files(C.entry_files(tree, entries), f"file://{tmp_path}", ".henc").collect()
    assert {r["slug"] for r in made} == {"a", "b"}
    assert sorted(map(tuple, C.read_entries(spark, str(tmp_path)).select(*entries.columns).collect()), key=lambda r: r[:2]) == rows
    assert sorted(tuple(r) for r in C.read_entries(spark, str(tmp_path), "tree").filter("slug = 'b'").select(*tree.columns).collect()) == nodes[3:]


def test_catalogue_books_and_donor_a_from_files(spark, tmp_path):
    (tmp_path / "catalog.json").write_text(json.dumps({"version": 1, "books": [{"slug": "b", "number": 2, "aliases": ["bb"], "chapters": 1, "hadiths": 2}, {"slug": "a", "number": 1}, {"slug": "none", "number": 3}]}))
    catalog = S.read_catalog(spark, str(tmp_path / "catalog.json"))
    assert [(r["slug"], r["number"], r["aliases"]) for r in catalog.orderBy("number").collect()] == [("a", 1, None), ("b", 2, ["bb"]), ("none", 3, None)]
    english = lambda t: {"narrator": "N", "text": t}
    for slug, ids in (("a", [7, 8]), ("b", [1, 1, 2])):
        book = {"id": 1, "chapters": [{"id": 1.0}, {"id": 8.2}], "hadiths": [{"id": i, "idInBook": i, "chapterId": 8.2, "citation": f"{i}a", "arabic": "ع", "english": english(f"t{n}")} for n, i in enumerate(ids)]}
        (tmp_path / "books").mkdir(exist_ok=True)
        (tmp_path / "books" / f"{slug}.json").write_text(json.dumps(book, ensure_ascii=False))
    books = S.read_books(spark, str(tmp_path / "books"))
    rows = S.records(books)
    assert [(r["position"], r["slug"], r["text"]) for r in S.in_catalog_order(rows, catalog).orderBy("position").collect()] == [(0, "a", "t0"), (1, "a", "t1"), (2, "b", "t0"), (3, "b", "t1"), (4, "b", "t2")]
    first = S.row_for(rows, "b", 1).first()
    assert (first["row"], first["chapter"], first["citation_base"], first["citation_suffix"]) == (0, 1082, 1, 1)
    assert S.of_chapter(rows, "b", 1082).count() == 3 and S.of_chapter(rows, "b", 1).count() == 0
    S.write_book_json(books, str(tmp_path / "out"))
    again = spark.read.text(f"{tmp_path}/out/slug=b").first()["value"]
    assert json.loads(again)["hadiths"][0]["arabic"] == "ع" and json.loads(again)["chapters"][1]["id"] == 8.2
    entry = lambda n, t, *g: {"hadithnumber": n, "text": t, "grades": [{"name": a, "grade": b} for a, b in g]}
    long = "a text that is long enough to tell " * 2
    (tmp_path / "donor").mkdir()
    (tmp_path / "donor" / "a.json").write_text(json.dumps({"hadiths": [entry(1, "x", (" N ", " Sahih "), ("M", " ")), entry(2, "  "), entry(3, long), entry(4, long + "b"), entry(5, long + "B.")]}))
    donor = S.read_donor_a(spark, str(tmp_path / "donor"))
    got = {r["position"]: (r["hadithnumber"], [tuple(g) for g in r["grades"]]) for r in donor.collect()}
    assert got[0] == ("1", [("N", "Sahih")]) and set(got) == {0, 2, 3, 4}
    assert [r["number"] for r in S.donor_numbers(donor).collect()] == [3]


def test_vector_packs_are_written_by_slug(spark, tmp_path):
    from scriptorium.sources import containers as C

    vectors = spark.createDataFrame([(s, w, v) for s in ("a", "b") for w, v in (("one", [3.0, 4.0]), ("two", [0.0, 2.0]))], "slug string, word string, vector array<double>")
    items = spark.createDataFrame([("a", 1, "k1", ["two", "one"]), ("a", 0, "k0", []), ("b", 0, None, ["one"])], "slug string, position long, key string, words array<string>")
    C.write_files(C.vector_files(vectors, items, 7, "ff"), str(tmp_path), ".svec").collect()
    got = C.read_vectors(spark, str(tmp_path), revision=7, fingerprint="ff").orderBy("slug", "word").collect()
    assert [(r["slug"], r["word"], [round(x, 2) for x in r["vector"]]) for r in got] == [(s, w, v) for s in ("a", "b") for w, v in (("one", [0.6, 0.8]), ("two", [0.0, 1.0]))]
    back = C.read_vector_items(spark, str(tmp_path)).orderBy("slug", "position").collect()
    assert [tuple(r) for r in back] == [("a", 0, "k0", []), ("a", 1, "k1", ["two", "one"]), ("b", 0, None, ["one"])]
