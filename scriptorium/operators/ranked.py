"""Ranked lexical search, contiguous scan, typo correction and word-vector search."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import words as W
from ..store import materialise

# Weights of the scoring.
TITLE, CITATION, BODY, PHRASE_TITLE, PHRASE_BODY = 12, 7, 3, 60, 25
WHOLE_WORD, STEM_PENALTY, FUZZY_PENALTY, RELAXED = 6, 2, 5, 40
FLOOR, FLOOR_SHARE, SEMANTIC_LIMIT = 0.38, 0.85, 20
#: Up to so many vectors their cosines, under 100 bytes each, are sent to all executors.
BROADCAST_VECTORS = 1 << 20


@dataclass(frozen=True)
class Token:
    text: str
    stem: str | None = None
    variant: str | None = None
    fuzzy: str | None = None


@dataclass(frozen=True)
class Query:
    is_arabic: bool
    phrase: str
    tokens: tuple[Token, ...]


@dataclass(frozen=True)
class Corpus:
    """rows: book, row, chapter, body_fold. chapters: book, chapter, title_fold. books: book, title_fold. Where rows are not
    numbered yet, place makes book, row and chapter from what else they hold; it never sees a text."""

    rows: DataFrame
    chapters: DataFrame
    books: DataFrame
    place: Callable[[DataFrame], DataFrame] = lambda hits: hits


def nearest_words(vocabulary: DataFrame, words: list[str]) -> dict[str, str]:
    """The correction of each word that has one: a word within 1 edit (2 from LONG_WORD letters on), the least by (distance,
    length, word). Words that are short, not Latin, or part of a vocabulary word are left alone. One pass, one row back."""
    words = [w for w in dict.fromkeys(words) if len(w) >= W.MIN_FUZZY and w.isascii() and w.isalpha() and w.islower()]
    if not words:
        return {}
    v = F.col("word")
    aggs = []
    for i, w in enumerate(words):
        limit = 2 if len(w) >= W.LONG_WORD else 1
        near = F.when(F.length(v).between(len(w) - limit, len(w) + limit), F.levenshtein(v, F.lit(w), limit))
        aggs += [F.max(v.contains(w)).alias(f"in{i}"), F.min(F.when(near >= 0, F.struct(near.alias("d"), F.length(v).alias("n"), v.alias("w")))).alias(f"best{i}")]
    row = vocabulary.agg(*aggs).first()
    return {w: row[f"best{i}"]["w"] for i, w in enumerate(words) if not row[f"in{i}"] and row[f"best{i}"] is not None}


def parse(spark: SparkSession, raw: str, vocabulary: DataFrame | None = None) -> Query | None:
    """The query's tokens, worked out by the same column functions that fold the corpus; None under two characters."""
    if len(raw.strip()) < 2:
        return None
    q = spark.range(1).select(F.lit(raw).alias("raw")).select(T.is_arabic(F.col("raw")).alias("a"), T.fold_query(F.col("raw")).alias("f")).first()
    words = q["f"].split()
    if not words:
        return None
    used = words if q["a"] else [w for w in words if w not in W.STOPWORDS] or words
    if q["a"]:
        return Query(True, " ".join(used), tuple(Token(w) for w in used))
    fixes = nearest_words(vocabulary, used) if vocabulary is not None else {}
    forms = spark.createDataFrame([(w,) for w in used], "w string").select("w", W.stem(F.col("w")).alias("s"), W.variant(F.col("w")).alias("v")).collect()
    return Query(False, " ".join(used), tuple(Token(r["w"], r["s"], r["v"], fixes.get(r["w"])) for r in forms))


def _padded(fold: Column) -> Column:
    return F.concat(F.lit(" "), F.translate(fold, "\n\t\r", "   "), F.lit(" "))


def token_hit(token: Token, fold: Column, weight: int) -> Column:
    """What one token is worth against a fold: the word itself, its variant, its stem, its correction; the first found counts."""
    pad = _padded(fold)
    out = F.when(pad.contains(f" {token.text} "), weight + WHOLE_WORD).when(fold.contains(token.text), weight)
    if token.variant:
        out = out.when(pad.contains(f" {token.variant} "), weight + WHOLE_WORD).when(fold.contains(token.variant), weight)
    if token.stem:
        out = out.when(pad.contains(f" {token.stem}"), max(1, weight - STEM_PENALTY))
    if token.fuzzy:
        out = out.when(pad.contains(f" {token.fuzzy}"), max(1, weight - FUZZY_PENALTY))
    return out.otherwise(0)


def score_rows(query: Query, corpus: Corpus) -> DataFrame:
    """book, row, score, matched of each row that carries a token. Titles are scored once a chapter. What a body is worth is
    worked out where it is read, so only numbers are shuffled."""
    n = len(query.tokens)
    titles = corpus.chapters.join(corpus.books.select("book", F.col("title_fold").alias("book_fold")), "book", "left")
    own = [F.greatest(token_hit(t, F.col("title_fold"), TITLE), token_hit(t, F.coalesce("book_fold", F.lit("")), CITATION)).alias(f"t{i}") for i, t in enumerate(query.tokens)]
    bonus = F.when(F.col("title_fold").contains(query.phrase), PHRASE_TITLE).otherwise(0) if n > 1 else F.lit(0)
    scored = titles.select("book", "chapter", *own, bonus.alias("title_bonus"))
    phrase = F.when(F.col("body_fold").contains(query.phrase), PHRASE_BODY).otherwise(0) if n > 1 else F.lit(0)
    others = [c for c in corpus.rows.columns if c != "body_fold"]
    hits = corpus.rows.select(*others, phrase.alias("body_bonus"), *(token_hit(t, F.col("body_fold"), BODY).alias(f"b{i}") for i, t in enumerate(query.tokens)))
    rows = corpus.place(hits).join(scored, ["book", "chapter"], "left").na.fill(0, ["title_bonus", *(f"t{i}" for i in range(n))])
    total = sum((F.col(f"t{i}") + F.col(f"b{i}") for i in range(n)), F.coalesce("title_bonus", F.lit(0)) + F.coalesce("body_bonus", F.lit(0)))
    matched = sum((F.when((F.col(f"t{i}") > 0) | (F.col(f"b{i}") > 0), 1).otherwise(0) for i in range(n)), F.lit(0))
    return rows.select("book", "row", total.cast("int").alias("score"), matched.cast("int").alias("matched")).filter("matched > 0")


def search(query: Query, corpus: Corpus, limit: int | None = None) -> DataFrame:
    """Hits with all tokens; if there are none and the query has several, those with the most, RELAXED more for each."""
    n = len(query.tokens)
    hits = score_rows(query, corpus)
    if limit is not None:  # the best rows have the most tokens, so no other row can be wanted
        hits = hits.orderBy(F.desc("matched"), F.desc("score"), "book", "row").limit(limit)
    # the best row whole, so that both sides read the same shuffled numbers and the engine makes them once
    best = hits.agg(F.coalesce(F.max(F.struct("matched", "score", "book", "row"))["matched"], F.lit(0)).alias("most"))
    hits = hits.join(F.broadcast(best)).filter((F.col("matched") == F.col("most")) & ((F.col("most") == n) | F.lit(n > 1)))
    relaxed = F.col("most") < n
    hits = hits.select("book", "row", (F.col("score") + F.when(relaxed, RELAXED * F.col("matched")).otherwise(0)).cast("int").alias("score"), "matched", relaxed.alias("relaxed"))
    return hits if limit is None else hits.orderBy(F.desc("score"), "book", "row").limit(limit)


def phrase_hit(fold: Column, folded: str) -> Column:
    return F.coalesce(fold.contains(folded), F.lit(False))


def contiguous_scan(rows: DataFrame, folded: str, fold_col: str = "body_fold") -> DataFrame:
    return rows.filter(F.col(fold_col).contains(folded))


def max_sim(items: DataFrame, vectors: DataFrame, query_words: list[str], limit: int = SEMANTIC_LIMIT, slot: Callable[[Column], Column] | None = None) -> DataFrame:
    """position, score of the items nearest in meaning: for each query word the best cosine over an item's words, then the
    mean. items: position, words; vectors: word, vector (zero vectors are dropped). Where words share vectors, slot makes of a
    word what vectors has as word; then only query words that some item holds are asked for. Cosines are worked out once a
    vector and go to the items' words, which are shuffled only where there are more vectors than BROADCAST_VECTORS; the best
    limit items are taken before the floor, which follows from the first of them."""
    spark, key = items.sparkSession, slot or (lambda w: w)
    places = spark.range(1).select(*(key(F.lit(w)).alias(f"k{i}") for i, w in enumerate(query_words))).first()
    found = vectors.filter(F.col("word").isin(*set(places))).select("word", "vector").collect()  # one for each query word
    known = {}
    for r in found:
        length = math.sqrt(sum(float(x) ** 2 for x in r["vector"]))
        if length > 0:
            known |= {q: [float(x) / length for x in r["vector"]] for q, w in enumerate(places) if w == r["word"]}
    nothing = items.limit(0).select("position", F.lit(0.0).alias("score"))
    if not known:
        return nothing
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    v = vectors.select("word", F.col("vector").cast("array<double>").alias("v")).withColumn("n", F.sqrt(dot(F.col("v"), F.col("v")))).filter("n > 0")
    cosines = v.select("word", *((dot(F.col("v"), F.lit(q)) / F.col("n")).alias(f"c{i}") for i, q in sorted(known.items())))
    cosines = materialise(cosines, "cosines")
    few = cosines.count() <= BROADCAST_VECTORS
    words = items.select("position", F.explode(F.array_distinct("words")).alias("word"))
    held = [(F.col("word") == query_words[q]).alias(f"h{q}") for q in known if slot]
    pairs = words.select("position", key(F.col("word")).alias("word"), *held).join(F.broadcast(cosines) if few else cosines, "word")
    per = pairs.groupBy("position").agg(*(F.max(f"c{q}").alias(f"c{q}") for q in known), *(F.max(f"h{q}").alias(f"h{q}") for q in known if slot))
    if slot:
        per = materialise(per, "best-cosines")  # a few numbers an item: the texts are read once
        held = per.agg(*(F.max(f"h{q}").alias(f"h{q}") for q in known)).first()
        known = {q: x for q, x in known.items() if held[f"h{q}"]}
        if not known:
            return nothing
    scored = per.select("position", (sum(F.col(f"c{q}") for q in known) / len(known)).alias("score"))
    top = scored.orderBy(F.desc("score"), "position").limit(limit)
    best = F.max("score").over(Window.orderBy(F.desc("score")))  # over limit rows at most
    floor = F.greatest(F.lit(FLOOR), FLOOR_SHARE * F.greatest(F.lit(0.0), F.col("best")))
    return top.withColumn("best", best).filter(F.col("score") >= floor).orderBy(F.desc("score"), "position").select("position", "score")
