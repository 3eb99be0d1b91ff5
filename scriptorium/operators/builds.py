"""Derived corpora and the gates before them: encyclopedia, subject index, citations, equality of what was built with what
it was built from. A build with a problem raises and writes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import marks as M
from ..functions import trees
from .linkage import diff, refuse, repeated_keys
from .ordered import with_neighbours

# The characters that a re-punctuated text may have in place of a dash, and the dash it must not keep.
DASHED, DASH = "[—–]| - ", "—"


def encyclopedia(core: DataFrame, translations: DataFrame, index: DataFrame) -> DataFrame:
    """id, categories, arabic and english of the entries that are translated, strings cleaned. core: id, arabic;
    translations: id, english; index: id, categories. Ids are strings of digits; an entry without an index row has no
    categories. Order by ``numeric(id)``."""
    none = F.array().cast("array<string>")
    j = core.select("id", "arabic").join(translations.select("id", "english"), "id").join(index.select("id", F.col("categories").alias("filed")), "id", "left")
    return trees.cleaned(j.select("id", F.coalesce("filed", none).alias("categories"), "arabic", "english"))


def numeric(c: Column) -> Column:
    """Sorts ids by number, however many digits they have."""
    digits = F.regexp_replace(c, "^0+(?=.)", "")
    return F.struct(F.length(digits).alias("n"), digits.alias("d"))


def orphan_categories(entries: DataFrame, tree: DataFrame) -> DataFrame:
    """(category, entries): categories of entries that the tree lacks. entries: id, categories; tree: id, parent."""
    used = entries.select(F.explode("categories").alias("category")).groupBy("category").agg(F.count("*").alias("entries"))
    return used.join(tree.select(F.col("id").alias("category")), "category", "left_anti")


def orphan_parents(tree: DataFrame) -> DataFrame:
    """(id, parent) of nodes whose parent the tree lacks."""
    return tree.filter("parent is not null").select("id", "parent").join(tree.select(F.col("id").alias("parent")), "parent", "left_anti").select("id", "parent")


def in_categories(entries: DataFrame, wanted: list[str]) -> DataFrame:
    """Entries that are filed under any of the wanted categories."""
    return entries.filter(F.arrays_overlap("categories", F.array(*map(F.lit, wanted))) if wanted else F.lit(False))


def fill_counts(entries: DataFrame, filled: dict[str, Column]) -> DataFrame:
    """One row: entries, for each name how many of them have its column filled (not null, empty text or array), and the most
    categories of an entry."""
    return entries.agg(F.count("*").alias("entries"), *(F.count_if(F.coalesce(F.length(F.to_json(F.struct(c.alias("v")))) > F.lit(len('{"v":""}')), F.lit(False))).alias(name) for name, c in filled.items()), F.max(F.size("categories")).alias("max_categories"))


def checked_encyclopedia(core: DataFrame, translations: DataFrame, index: DataFrame, tree: DataFrame) -> DataFrame:
    """The encyclopedia; raises if an entry is filed under a category that the tree lacks."""
    out = encyclopedia(core, translations, index)
    refuse(orphan_categories(out, tree), "categories that the tree lacks")
    return out


def topic_entries(raw: DataFrame, records: DataFrame) -> DataFrame:
    """raw entries with slug, citation and whether the record they point at is graded. raw: id, reference, topic, lane and
    more; records: slug, citation, grades. found and graded are null where no record has the citation."""
    own = raw.withColumns({"slug": M.topic_reference(F.col("reference"), F.col("id"), 1), "citation": M.topic_reference(F.col("reference"), F.col("id"), 2)})
    known = records.filter("citation <> ''").groupBy(F.col("slug").alias("known_slug"), F.col("citation").alias("known_citation")).agg(F.max(F.coalesce(F.size("grades") > 0, F.lit(False))).alias("graded"))
    return own.join(known, (F.col("slug") == F.col("known_slug")) & (F.col("citation") == F.col("known_citation")), "left").withColumn("found", F.col("known_slug").isNotNull()).drop("known_slug", "known_citation")


def topic_problems(entries: DataFrame, lanes: DataFrame, topics: DataFrame, slugs: list[str]) -> DataFrame:
    """(id, problem) of entries from ``topic_entries``: no citation, a foreign book, a citation that no record has, an unknown
    topic or lane, and each further entry of a (book, citation, topic). lanes and topics: id."""
    covered = F.col("slug").isin(slugs)
    has = lambda df, c: entries.join(df.select(F.col("id").alias("known_id")).distinct(), F.col(c) == F.col("known_id"), "left_anti")
    first = F.when(F.col("citation").isNull(), "no citation").when(~covered, "foreign book").when(~F.col("found"), "not on the shelf")
    told = entries.select("id", first.alias("problem")).filter("problem is not null")
    good = covered & F.col("found")
    for df, c in ((topics, "topic"), (lanes, "lane")):
        told = told.unionByName(has(df, c).filter(good).select("id", F.lit(f"unknown {c}").alias("problem")))
    twice = repeated_keys(entries.filter(good), ["slug", "citation", "topic"]).select("slug", "citation", "topic")
    again = entries.join(twice, ["slug", "citation", "topic"])
    least = again.groupBy("slug", "citation", "topic").agg(F.min("id").alias("least"))
    again = again.join(least, ["slug", "citation", "topic"]).filter("id <> least").select("id", F.lit("duplicate").alias("problem"))
    return told.unionByName(again)


def build_topics(raw: DataFrame, records: DataFrame, lanes: DataFrame, topics: DataFrame, slugs: list[str]) -> DataFrame:
    """Entries with slug and citation, by rank; raises if any entry has a problem."""
    entries = topic_entries(raw, records)
    refuse(topic_problems(entries, lanes, topics, slugs), "the subject index has problems")
    return entries.drop("found", "reference").orderBy("rank", "id")


def cross_lane(entries: DataFrame, topics: DataFrame) -> DataFrame:
    """(lane, topic_lane, entries): entries by their own lane and by their topic's. topics: id, lane; they are few."""
    t = topics.select(F.col("id").alias("topic_id"), F.col("lane").alias("topic_lane"))
    return entries.join(t, F.col("topic") == F.col("topic_id")).groupBy("lane", "topic_lane").agg(F.count("*").alias("entries"))


def settled_citations(cited: DataFrame) -> DataFrame:
    """cited with base and suffix settled and fixed: where a second donor's number differs, it is taken if it fits strictly
    between the nearest citations that nothing contradicts and the own number does not. cited: book, row, base (int, null
    without a citation), suffix, second (int, null where the second donor tells nothing)."""
    suspect = F.coalesce(F.col("base") != F.col("second"), F.lit(False))
    d = cited.withColumn("sure", F.when(~suspect, F.col("base")))
    d = with_neighbours(d, "book", "row", {"lo": "sure"}, {"hi": "sure"})
    fits = lambda c: F.coalesce((F.col("lo") < F.col(c)) & (F.col(c) < F.col("hi")), F.lit(False))
    both = F.col("lo").isNotNull() & F.col("hi").isNotNull()
    d = d.withColumn("fixed", suspect & both & ~fits("base") & fits("second"))
    return d.withColumns({"base": F.when(F.col("fixed"), F.col("second")).otherwise(F.col("base")), "suffix": F.when(F.col("fixed"), 0).otherwise(F.col("suffix"))}).drop("sure", "lo", "hi")


def citation_stats(settled: DataFrame) -> DataFrame:
    """A row for each book: rows, cited, fixed, agree and disagree with the second donor."""
    asked = F.col("second").isNotNull() & F.col("base").isNotNull()
    same = asked & (F.col("second") == F.col("base"))
    return settled.groupBy("book").agg(F.count("*").alias("n_rows"), F.count("base").alias("cited"), F.count_if("fixed").alias("fixed"), F.count_if(same).alias("agree"), F.count_if(asked & ~same).alias("disagree"))


def gate(built: DataFrame, source: DataFrame, keys: list[str], what: str = "the build differs from its source") -> None:
    """Raises unless both have the same keys with equal columns, each key once."""
    for df in (built, source):
        refuse(repeated_keys(df, keys), f"{what}: repeated keys")
    refuse(diff(built, source, keys).withColumn("problem", F.when(F.col("l").isNull(), "missing").when(F.col("r").isNull(), "extra").otherwise("changed")).select(*keys, "problem"), what)


def shape(rows: DataFrame, group: str, counts: dict[str, Column]) -> DataFrame:
    """A row for each group, and one with a null group for all: n_rows, and for each name the rows for which its column holds."""
    return rows.rollup(group).agg(F.count("*").alias("n_rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in counts.items()))


def shape_gate(got: DataFrame, want: dict) -> None:
    """Raises unless the one row of counts has the wanted values."""
    row = got.first().asDict()
    wrong = {k: (v, row.get(k)) for k, v in want.items() if row.get(k) != v}
    if wrong:
        raise ValueError("counts differ (wanted, found): " + ", ".join(f"{k} {a} {b}" for k, (a, b) in sorted(wrong.items())))


def softened_problem(source: Column, built: Column) -> Column:
    """What is wrong with a text whose dashes a reader may have re-punctuated, null if nothing: paragraphs must be as many,
    those without a dash equal, and in the others the words the same and no em dash left."""
    a, b = F.split(source, "\n\n"), F.split(built, "\n\n")
    words = lambda s: F.regexp_extract_all(F.lower(s), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    judged = F.transform(pairs, lambda p: F.when(~p["a"].rlike(DASHED), F.when(p["a"] != p["b"], "text")).when(p["b"].contains(DASH), "dash").when(words(p["a"]) != words(p["b"]), "words"))
    return F.when(F.size(a) != F.size(b), "paragraphs").otherwise(F.try_element_at(F.array_compact(judged), F.lit(1)))
