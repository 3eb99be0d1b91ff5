"""The pipeline: stages in order, their contracts, odd rows, and its result against the stages' operators."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from scriptorium.llm import common, jaccard, quality
from scriptorium.llm.common import materialise


def test_stages(spark, small):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "packing"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        kept = materialise(stage(spark, docs, small), name)
        assert kept.columns == columns
        after = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert after <= ids and len(after) == kept.count()
        if name == "quality_rules":
            good = quality.with_verdict(materialise(quality.with_counts(docs), "c")).filter("kept")
            assert after == {r["doc_id"] for r in good.collect()} and len(after) < before
        if name == "near_duplicates":
            groups = Counter(r["class_id"] for r in jaccard.ngram_jaccard_join(docs).collect())
            assert after == set(groups) and max(groups.values()) > 1
        docs = kept
    pieces = corpus_pipeline.run(spark, small)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_against_brute_force(spark, small):
    """Every stage worked out without its operator: windows one by one, SQL, all pairs, the tokenizers library."""
    import os
    import re

    import duckdb
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    from scriptorium.llm import langid, tokens

    table = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in table.collect()}
    net = langid.fit_languages(table.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    pairs = [np.concatenate([w, np.zeros((1,) + w.shape[1:])]) for w in map(np.stack, net.tables)]

    def score(text):
        raw, total = text.encode(), np.zeros(len(net.langs))
        for at in range(0, max(1, len(raw)), 128):
            own = raw[at : at + 128]
            b = np.frombuffer(own.ljust(132, b"\0"), np.uint8)
            hidden = np.concatenate([np.max([sum(w[k][b[p + k]] for k in range(len(w) - 1)) for p in range(127)], axis=0) for w in pairs])
            z = np.maximum(hidden, 0) @ net.out + net.bias
            total += np.exp(z - z.max()) / np.exp(z - z.max()).sum() * len(own)
        return total.max() / max(1, len(raw))

    kept = {i for i, t in rows.items() if t and re.search(r"[^\W\d_]", t) and score(t) >= langid.MIN_SCORE}
    con = duckdb.connect()
    con.register("ids", pa.table({"id": sorted(kept)}))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet' WHERE doc_id IN (SELECT id FROM ids)")
    kept = {i for (i,) in con.sql(f"SELECT doc_id FROM ({quality.OP5_SQL}) WHERE kept").fetchall()}
    grams = {}
    for i in sorted(kept):
        w = [x for x in re.split(rb"[^0-9A-Za-z\x80-\xff]+", rows[i].lower().encode()) if x]
        grams[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in kept}
    find = lambda i: i if root[i] == i else find(root[i])
    ids = sorted(kept)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]) - 1e-9:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = {i for i in kept if find(i) == i}
    library = Tokenizer.from_file(tokens.default_path())
    want = {i: library.encode(rows[i], add_special_tokens=False).ids + [1] for i in kept}
    got, before = {}, set(os.listdir(common.shared_root(spark).removeprefix("file://")))
    for r in corpus_pipeline.run(spark, small).orderBy("doc_id", "start").collect():
        assert r["start"] == len(got.setdefault(r["doc_id"], []))
        got[r["doc_id"]] += r["ids"]
    assert got == want
    left = set(os.listdir(common.shared_root(spark).removeprefix("file://"))) - before
    assert len(left) == 1  # the documents that the result is read from


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string, n_repeat_words string, base_failed string, lang_pred string, lang_score string, doc string, id string, key string, cls string, __w string, __id string, __rows string, __pred string, fence_lang string, `odd name` string"


def test_stages_return_columns_as_they_are(spark, small):
    """Clashing names, null ids, texts and labels, repeated rows, two texts with one id, a very long text."""
    base = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    long = " ".join(base[0][1].split()[:40]) + " " + " ".join(f"{w}{i}" for i in range(3000) for w in base[0][1].split()[:8])
    odd = [(None, base[0][1], "en", "s"), (None, None, None, None), (5001, None, "en", "s"), (5002, "", None, None), (5003, long, "en", None), (5004, base[1][1], None, "s"), (5004, base[2][1], "en", "s"), base[3], base[3]]
    rows = [(*r[:4], 1, 7, "yes", "no", "q", "de", "0.1", "d", "i", "k", "c", "w", "_", "r", "p", "f", "o") for r in base + odd]
    docs = spark.createDataFrame(rows, CLASHING)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, docs, small), name)
        assert kept.columns == docs.columns
        before, after = Counter(map(tuple, docs.collect())), Counter(map(tuple, kept.collect()))
        assert after and not after - before
        docs = kept
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() > 0


def test_near_duplicates_go_by_row(spark):
    """A different text that shares an id is a document of its own, whichever of its id's texts has copies."""
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    docs = spark.createDataFrame([(5, x, 1), (5, y, 2), (6, x, 3), (3, z, 4), (5, z, 5), (7, y, 6), (5, y, 7)], "doc_id long, text string, place int")
    out = jaccard.near_duplicate_stage(spark, docs, "")
    assert sorted((r["doc_id"], r["text"], r["place"]) for r in out.collect()) == sorted([(5, x, 1), (5, y, 2), (3, z, 4)])


def test_near_duplicates_keep_one_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (3, None), (None, text), (4, "other words are here today")], "doc_id long, text string")
    out = jaccard.near_duplicate_stage(spark, docs, "")
    assert sorted((r["doc_id"] or 0, r["text"] is None) for r in out.collect()) == [(0, False), (1, False), (3, True), (4, False)]


def test_empty_input(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, small), "e")
        assert docs.count() == 0
