"""The composed repairs: match, refuse, restore, log, count. Nothing is written; the callers write what is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import marks as M
from ..functions import text as T
from .boundary import restored
from .linkage import matched_by_key, proofs

LOG_KEY = ["book", "id"]


def pass_one(rows: DataFrame, donors: DataFrame) -> DataFrame:
    """rows with narrator and body repaired where a donor, with its brackets deleted line by line, is the row; status is
    repaired, ambiguous, unchanged or unmatched; scarred, before and narrator_folded tell the rest.
    rows: book, id, narrator, body; donors: book, ord, body. Each row is matched once, whatever else has its (book, id), and
    one whose body is null meets no donor.
    The match of keys is the proof that ``restored`` asks for, so no repaired row is unprovable, and statuses need no text."""
    key = F.when(F.col("body").isNotNull(), T.digest(T.norm_key(F.concat_ws(" ", "narrator", "body"))))
    own = rows.select("book", "id", F.coalesce("narrator", F.lit("")).alias("narrator"), F.coalesce("body", F.lit("")).alias("body"), key.alias("key"))
    old = F.col("body")
    found = matched_by_key(own.select("*", T.looks_scarred(old).alias("scarred")), donors.select("book", "ord", "body"), ["book"])
    new = F.col("status") == "repaired"
    found = found.withColumn("r", restored(F.col("repaired"), F.when(new, F.col("narrator")), F.when(new, old), "deletion"))
    return found.select(
        "book", "id", F.when(new, F.col("r.narrator")).otherwise(F.col("narrator")).alias("narrator"), F.when(new, F.col("r.body")).otherwise(old).alias("body"), "status",
        "scarred", F.when(new, old).alias("before"), F.when(new, F.col("r.folded")).alias("narrator_folded"),
    )


def pass_one_stats(repaired: DataFrame) -> DataFrame:
    """A row for each book: total, damaged, repaired, ambiguous, unmatched_scarred, unprovable."""
    is_ = lambda *s: F.col("status").isin(*s)
    return repaired.groupBy("book").agg(
        F.count("*").alias("total"), F.count_if(is_("repaired", "unprovable")).alias("damaged"), F.count_if(is_("repaired")).alias("repaired"), F.count_if(is_("ambiguous")).alias("ambiguous"),
        F.count_if(~is_("repaired", "unprovable") & F.coalesce("scarred", F.lit(False))).alias("unmatched_scarred"), F.count_if(is_("unprovable")).alias("unprovable"),
    )


def pass_two(rows: DataFrame, donors: DataFrame, log: DataFrame | None = None, radius: int = 64) -> DataFrame:
    """rows with narrator and body repaired where each donor that proves the row proves it with one text, and all such texts
    have one key. status: repaired, ambiguous (donors disagree), unprovable, unchanged (nothing was recovered), logged (an
    earlier pass has repaired it) or unmatched. rows: book, id, narrator, body; donors: book, ord, clean, a donor being an
    ord; log: book, id. The text of the first donor is taken."""
    own = rows.select("book", "id", F.coalesce("narrator", F.lit("")).alias("narrator"), F.coalesce("body", F.lit("")).alias("body"))
    whole = T.norm_key(F.concat_ws(" ", "narrator", "body"))
    # a donor's texts of a book are a sequence of their own
    of_donor = donors.select(F.struct("book", "ord").alias("book"), "clean")
    kinds = donors.select("book", "ord").distinct()
    targets = own.select("book", "id", whole.alias("key")).join(F.broadcast(kinds), "book").select(F.struct("book", "ord").alias("book"), "id", "key")
    proved, texts = proofs(targets, of_donor, radius)
    hits = proved.filter("lo = hi").select("book.book", "book.ord", "id", F.col("lo").alias("key"))
    agreed = hits.groupBy("book", "id").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").cast("int").alias("confirmed_by"), F.min("ord").alias("ord"))
    # only the texts of donors that agree are fetched
    texts = texts.select("book.book", "book.ord", F.col("key").alias("lo"), F.col("key").alias("hi"), "clean")
    agreed = agreed.join(texts, ["book", "ord", "lo", "hi"], "left").drop("ord")
    j = own.join(agreed, ["book", "id"], "left")
    one = F.col("lo") == F.col("hi")
    j = j.withColumn("r", restored(F.when(one, F.col("clean")), F.col("narrator"), F.col("body"), "grouping"))
    logged = F.lit(None).cast("boolean")
    if log is not None:
        j = j.join(log.select("book", "id", F.lit(True).alias("logged")).distinct(), ["book", "id"], "left")
        logged = F.col("logged")
    same = T.norm_key(F.concat_ws(" ", "r.narrator", "r.body")) == whole
    status = F.when(F.col("lo").isNull(), "unmatched").when(~one, "ambiguous").when(F.col("r.body").isNull(), "unprovable").when(same, "unchanged").when(logged, "logged").otherwise("repaired")
    new = F.col("status") == "repaired"
    return j.withColumn("status", status).select(
        "book", "id", F.when(new, F.col("r.narrator")).otherwise(F.col("narrator")).alias("narrator"), F.when(new, F.col("r.body")).otherwise(F.col("body")).alias("body"), "status",
        T.looks_scarred(F.col("body")).alias("scarred"), F.when(new, F.col("body")).alias("before"), F.when(new, F.col("r.folded")).alias("narrator_folded"), F.when(new, F.col("confirmed_by")).alias("confirmed_by"),
    )


def pass_two_stats(repaired: DataFrame) -> DataFrame:
    """A row for each book: total, repaired, one_donor, ambiguous, scarred_left (without a donor)."""
    is_ = lambda s: F.col("status") == s
    return repaired.groupBy("book").agg(
        F.count("*").alias("total"), F.count_if(is_("repaired")).alias("repaired"), F.count_if(is_("repaired") & (F.col("confirmed_by") == 1)).alias("one_donor"),
        F.count_if(is_("ambiguous")).alias("ambiguous"), F.count_if(is_("unmatched") & F.coalesce("scarred", F.lit(False))).alias("scarred_left"),
    )


def log_entries(repaired: DataFrame, name: str | None = None) -> DataFrame:
    """What a pass has repaired: book, id, before, after, narrator_folded, confirmed_by and pass, null for the first pass."""
    confirmed = F.col("confirmed_by") if "confirmed_by" in repaired.columns else F.lit(None)
    return repaired.filter("status = 'repaired'").select("book", "id", "before", F.col("body").alias("after"), "narrator_folded", confirmed.cast("int").alias("confirmed_by"), F.lit(name).cast("string").alias("pass"))


def merged_log(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both logs; of two entries of a row the old one stays."""
    return old.unionByName(new.join(old.select(*LOG_KEY).distinct(), LOG_KEY, "left_anti"))


def trimmed_log(log: DataFrame) -> DataFrame:
    """The log with the leading punctuation of its new texts trimmed, as ``trim_logged`` trims the rows'."""
    after = T.trim_lead(F.col("after"))
    return log.withColumn("after", F.when(after != "", after).otherwise(F.col("after")))


def repaired_grades(rows: DataFrame, grades_col: str = "grades") -> DataFrame:
    """rows with the artifacts of each grade repaired; a grade whose repair would lose its verdict stays as it is."""
    fix = lambda g: F.struct(g["name"].alias("name"), F.coalesce(M.repair_grade(g["grade"], g["name"]), g["grade"]).alias("grade"))
    return rows.withColumn(grades_col, F.transform(grades_col, fix))


def grade_report(rows: DataFrame, grades_col: str = "grades") -> DataFrame:
    """One row: scanned grades, those repaired and those refused."""
    g = rows.select(F.explode(grades_col).alias("g")).select(F.col("g.grade").alias("old"), M.repair_grade(F.col("g.grade"), F.col("g.name")).alias("new"))
    known = F.col("old").isNotNull()
    return g.agg(F.count("*").alias("scanned"), F.count_if(F.col("new") != F.col("old")).alias("repaired"), F.count_if(known & F.col("new").isNull()).alias("refused"))


def grade_stats(rows: DataFrame) -> DataFrame:
    """A row for each book: rows, graded, percent_graded, cited, percent_cited, graders. rows: book, grades, citation."""
    has = F.coalesce(F.size("grades") > 0, F.lit(False))
    names = rows.select("book", F.explode("grades").alias("g")).filter("g.name <> ''").groupBy("book").agg(F.countDistinct("g.name").alias("graders"))
    per = rows.groupBy("book").agg(F.count("*").alias("n_rows"), F.count_if(has).alias("graded"), F.count_if(F.coalesce(F.col("citation") != "", F.lit(False))).alias("cited"))
    share = lambda c: F.round(100 * F.col(c) / F.col("n_rows"), 1)
    return per.join(names, "book", "left").select("book", "n_rows", "graded", share("graded").alias("percent_graded"), "cited", share("cited").alias("percent_cited"), F.coalesce("graders", F.lit(0)).alias("graders"))
