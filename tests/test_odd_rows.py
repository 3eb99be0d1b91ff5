"""Queries on rows that the tables at hand do not hold, against their SQL; steps that must not grow faster than their input."""

import bisect
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import linkage as L
from scriptorium.plans import catalogue

from .compare import same


@pytest.fixture(scope="module")
def odd(spark, small, tmp_path_factory):
    """The small tables with some texts at whose edges lies white space, with odd line ends, and with nulls."""
    root = tmp_path_factory.mktemp("odd")
    for name in os.listdir(small):
        os.symlink(f"{small}/{name}", root / name)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = [" led by a space", "\n\tand a line", "ends  \n", "a\r\nb\rc", "wide\u00a0", "\u2028wide", "end \u0085", "\u001cend\u001f", "", "  ", "|held|", "\ufdd0b \ufdd0a \ufdd0", None, "[a\nb] c", "[a [b] c] d [e", "A \u0130\u212a b", "may allah be [x] pleased with him"]
    rows = [(1000 + 4 * i + j, t, lang, source, len(t or "")) for i, t in enumerate(texts) for j, (lang, source) in enumerate((("en", "src1"), ("de", "src2"), (" en", " src1\r"), ("en", None)))]
    os.unlink(root / "documents.parquet")
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(str(root / "documents.parquet"))
    labels = spark.read.parquet(f"{small}/labels.parquet")
    os.unlink(root / "labels.parquet")
    labels.unionByName(spark.createDataFrame([(1000, 1, 0), (1004, None, 1), (1006, 0, None)], labels.schema)).write.parquet(str(root / "labels.parquet"))
    return str(root)


@pytest.mark.parametrize("name", ["encyclopedia_build", "bracket_proof"])
def test_odd_rows_equal_sql(spark, odd, name):
    same(spark, odd, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("head", [1, 3, 64])
def test_window_is_exact_whatever_the_heads_tell(spark, monkeypatch, head):
    """Proofs in windows of the sorted keys against plain loops, where heads tell little and where they tell all."""
    monkeypatch.setattr(L, "HEAD", head)
    r = random.Random(head)
    words = ["".join(r.choice("ab") for _ in range(r.randrange(1, 6))) for _ in range(60)]
    donors = [("b", f"{w} [{''.join(r.choice('abz') for _ in range(3))}] end") for w in words for _ in range(3)]
    targets = [("b", i, w + "end") for i, w in enumerate(words)]
    key = lambda s: re.sub("[^a-z0-9]", "", s.lower())
    clean = {}
    for _, c in donors:
        clean[key(c)] = min(c, clean.get(key(c), c))
    order, want = sorted(clean), {}
    for _, i, t in targets:
        place = bisect.bisect_left(order, t)
        near = [k for k in order[max(place - 2, 0) : place + 2] if k != t and key(re.sub(r"\[[^\]]*\]", "", clean[k])) == t]
        want[i] = ("repaired", clean[near[0]]) if len(near) == 1 else ("ambiguous" if near else "unmatched", None)
    got = L.proof_status(spark.createDataFrame(targets, "book string, id long, key string"), spark.createDataFrame(donors, "book string, clean string"), 2)
    assert {x["id"]: (x["status"], x["clean"]) for x in got.collect()} == want and {s for s, _ in want.values()} == {"repaired", "ambiguous", "unmatched"}


def test_proofs_move_digests_only(spark):
    """What proofs shuffle does not hold the texts: grades of long texts are found by plans without them in an exchange."""
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(50))
    rows = spark.createDataFrame([("b", i, "S", text(i) + " zz") for i in range(40)], "book string, id long, narrator string, text string")
    entries = spark.createDataFrame([("b", i, "S " + text(i) + " [x] zz", [("n", f"g{i}")]) for i in range(40)], "book string, ord long, text string, grades array<struct<name:string,grade:string>>")
    stored = []
    keep = L.materialise
    try:
        L.materialise = lambda df, name: stored.append(df) or keep(df, name)
        out = L.lookup_grades(rows, entries)
        assert {r["id"]: r["grades"][0]["grade"] for r in out.collect()} == {i: f"g{i}" for i in range(40)}
    finally:
        L.materialise = keep
    longest = [df.agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] for df in stored]
    assert max(x or 0 for x in longest) < len(text(10))
