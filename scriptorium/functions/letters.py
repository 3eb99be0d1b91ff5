"""Arabic letters typed with Persian code points, spelling skeletons, string literals, names of books."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words with Persian letters and their Arabic spelling, applied in this order as substrings.
SPELLINGS = """
اِلَیْهَا اِلَيْهَا
خَیْرٌ خَيْرٌ
خَیْرُ خَيْرُ
عَلَی عَلَى
لَیْسَ لَيْسَ
أُمَّتِیْ أُمَّتِيْ
أیَّامٍ أيَّامٍ
إِسْتَعِیْنُوْا إِسْتَعِيْنُوْا
الاکوع الاكوع
الدُّنْیَا الدُّنْيَا
الدِّیَارَ الدِّيَارَ
السُّفْلَی السُّفْلَى
الْبَیَانِ الْبَيَانِ
الْتَّقْوَی الْتَّقْوَى
الْحَیَاءُ الْحَيَاءُ
الْخَمِیْسِ الْخَمِيْسِ
الْخَیْرِ الْخَيْرِ
الْسَّعِیْدُ الْسَّعِيْدُ
الْعُلْیَا الْعُلْيَا
الْکَافِرِ الْكَافِرِ
الْکَفِّ الْكَفِّ
الْیَدُ الْيَدُ
الْیَدِ الْيَدِ
الْیَمِینُ الْيَمِينُ
امیۃ امية
بُکُوْرِهَا بُكُوْرِهَا
بِالنِّیَّةِ بِالنِّيَّةِ
بِالْکِتْمَانِ بِالْكِتْمَانِ
بِغَیْرِهِ بِغَيْرِهِ
جَاءَکُمْ جَاءَكُمْ
رمثۃ رمثة
سَیِّدُ سَيِّدُ
شَهِیْدٌ شَهِيْدٌ
شَکَرَ شَكَرَ
عَلی عَلى
فَاَکْرِمُوهُ فَاَكْرِمُوهُ
فِی فِي
فِیْ فِيْ
قَیْئِهِ قَيْئِهِ
لَحِکْمَةً لَحِكْمَةً
مُوَکِّلٌ مُوَكِّلٌ
والیوم واليوم
کَأسْنَانِ كَأسْنَانِ
کَادَ كَادَ
کَالرَّاجِعِ كَالرَّاجِعِ
کَالْمُعَایَنَةِ كَالْمُعَايَنَةِ
کَاَخْذِ كَاَخْذِ
کَرِیْمُ كَرِيْمُ
کَفَاعِلِهِ كَفَاعِلِهِ
کَمَنْ كَمَنْ
کُفْرًا كُفْرًا
کُلُّهُ كُلُّهُ
یَحِلُّ يَحِلُّ
یَرَاهُ يَرَاهُ
یَرَی يَرَى
یَشْکُرُ يَشْكُرُ
یَوْمَ يَوْمَ
یَکُوْنَ يَكُوْنَ
یُصِمُّ يُصِمُّ
یُعْمِيْ يُعْمِيْ
یَّجُهْرَ يَّجُهْرَ
"""
PERSIAN = {"\u06cc": "\u064a\u0649", "\u06a9": "\u0643", "\u06c3": "\u0629"}  # each letter and what it can stand for
BARE_MARKS = r"[\x{64B}-\x{652}\x{670}\x{653}-\x{655}\x{6D6}-\x{6ED}]"
VOWEL_MARKS = "\u064b\u064c\u064d\u064e\u064f\u0650\u0651\u0652\u0653\u0654\u0655\u0670\u06e1"
SUKOON = r"[\x{652}\x{6E1}]"
# Words that name no book by themselves.
ARTICLES = "al an as ad at the of imam".split()
GENERIC = "sahih sunan jami musnad hadith forty book collection".split()


def spellings() -> list[tuple[str, str]]:
    return [tuple(line.split()) for line in SPELLINGS.split("\n") if line]


def respell(s: Column) -> Column:
    """Every listed word replaced wherever it occurs, in the order of the list."""
    for wrong, right in spellings():
        s = F.replace(s, F.lit(wrong), F.lit(right))
    return s


def respell_counts(s: Column) -> Column:
    """How many characters of a text are Persian letters that stand for Arabic ones."""
    return F.length(s) - F.length(F.translate(s, "".join(PERSIAN), ""))


def arabic_words(s: Column) -> Column:
    """Words of a text without their marks."""
    runs = F.filter(F.split(s, r"[^\x{600}-\x{6FF}]+"), lambda w: w != "")
    return F.transform(runs, lambda w: F.regexp_replace(w, BARE_MARKS, ""))


def spelling_report(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, expected, best, n): what the texts use most of the spellings that each listed word can stand for. best is
    null where they use none; of equally frequent ones the first by the letters' order wins. The texts are counted once,
    by word, before they meet the list, which has a fixed size."""
    from itertools import product

    rows = []
    for wrong, right in spellings():
        for i, letters in enumerate(product(*(PERSIAN.get(c, c) for c in wrong))):
            rows.append((wrong, right, i, "".join(letters)))
    listed = texts.sparkSession.createDataFrame(rows, "word string, expected string, i int, spelled string").withColumn("bare", F.regexp_replace("spelled", BARE_MARKS, ""))
    counts = texts.select(F.explode(arabic_words(F.col(text_col))).alias("bare")).join(F.broadcast(listed.select("bare").distinct()), "bare", "left_semi").groupBy("bare").agg(F.count("*").alias("n"))
    met = listed.join(counts, "bare", "left")
    order = F.struct(F.col("n"), -F.col("i"))
    return met.groupBy("word", "expected").agg(F.max_by(F.when(F.col("n").isNotNull(), F.col("spelled")), order).alias("best"), F.coalesce(F.max("n"), F.lit(0)).alias("n"))


def nfc(s: Column) -> Column:
    """Composed form, by the ICU library that the engine uses for its collations; so no text goes to Python."""
    return F.when(s.isNotNull(), F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), s, F.lit(False)))


def skeleton(s: Column) -> Column:
    """The letters without vowel marks: what a vocalisation must leave alone."""
    return F.translate(nfc(s), VOWEL_MARKS, "")


_ESCAPE = re.compile(r"\\(?:u\{([0-9A-Fa-f]+)\}|([nt\"\\'0]))")
_PLAIN = {"n": "\n", "t": "\t", "0": "\0"}


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    r"""The text of a string literal with \n, \t, \0, quotes, backslashes and \u{...}; other backslashes stay."""
    put = lambda m: chr(int(m[1], 16)) if m[1] else _PLAIN.get(m[2], m[2])
    return s.map(lambda x: _ESCAPE.sub(put, x), na_action="ignore")


def catalogue_changes(ours: DataFrame, theirs: DataFrame, key: str, fields: list[str], lists: list[str]) -> DataFrame:
    """(key, field, before, after, verdict) of each differing field: `letters` (the Arabic letters changed), `sukoon`, `list`
    are refusals; `marks` and `plain` are changes. A row of one side only is refused as `missing`."""
    text = lambda c: F.to_json(F.col(c)) if c in lists else F.col(c)
    tall = lambda df: df.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("field"), text(c).alias("value")) for c in fields))).alias("f")).select(key, "f.field", "f.value")
    a, b = tall(ours).withColumnRenamed("value", "before").withColumn("l", F.lit(1)), tall(theirs).withColumnRenamed("value", "after").withColumn("r", F.lit(1))
    both = a.join(b, [key, "field"], "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")) | F.col("l").isNull() | F.col("r").isNull())
    script = r"[\x{600}-\x{6FF}]"
    arabic = F.coalesce(F.col("before").rlike(script), F.lit(False)) | F.coalesce(F.col("after").rlike(script), F.lit(False))
    verdict = F.when(F.col("l").isNull() | F.col("r").isNull(), "missing").when(F.col("field").isin(lists), "list").when(~arabic, "plain")
    verdict = verdict.when(~skeleton(F.col("before")).eqNullSafe(skeleton(F.col("after"))), "letters").when(F.col("after").rlike(SUKOON), "sukoon").otherwise("marks")
    return both.select(key, "field", "before", "after", verdict.alias("verdict"))


def synchronised(ours: DataFrame, theirs: DataFrame, key: str, fields: list[str], lists: list[str]) -> DataFrame:
    """ours with their text fields; raises, and changes nothing, if any change is refused."""
    changes = catalogue_changes(ours, theirs, key, fields, lists)
    refused = changes.filter(~F.col("verdict").isin("marks", "plain")).limit(20).collect()
    if refused:
        raise ValueError("refused: " + "; ".join(f"{r[key]}.{r['field']} ({r['verdict']})" for r in refused))
    new = theirs.select(F.col(key), *(F.col(c).alias(f"__{c}") for c in fields))
    return ours.join(new, key).select(*(F.col(f"__{c}").alias(c) if c in fields else F.col(c) for c in ours.columns))


def name_words(s: Column) -> Column:
    """Words of a reference without articles and generic words."""
    words = F.filter(F.split(F.regexp_replace(F.lower(s), "['\u2019\u02bc]", ""), "[^a-z0-9]+"), lambda w: w != "")
    return F.filter(words, lambda w: ~w.isin(*ARTICLES, *GENERIC))


def resolve_references(references: DataFrame, id_col: str, text_col: str, books: DataFrame) -> DataFrame:
    """(id, slug, number) of references such as "nasa'i 5". books: slug, aliases array<string>. A name that fits no book or
    more than one has no row. Names are matched as a whole or word by word; numbers name no book."""
    words = references.select(F.col(id_col).alias("id"), name_words(F.col(text_col)).alias("w"))
    names = F.filter("w", lambda w: ~w.rlike("^[0-9]+[a-z]?$"))
    words = words.select("id", names.alias("names"), F.try_element_at(F.filter("w", lambda w: w.rlike("^[0-9]+[a-z]?$")), F.lit(-1)).alias("number"))
    tried = words.select("id", "number", F.explode(F.array_distinct(F.concat("names", F.array(F.array_join("names", ""))))).alias("alias")).filter("alias <> ''")
    aliases = books.select("slug", F.explode("aliases").alias("alias")).distinct()
    hits = tried.join(aliases, "alias").groupBy("id").agg(F.min("slug").alias("slug"), F.max("slug").alias("other"), F.first("number").alias("number"))
    return hits.filter("slug = other").select("id", "slug", "number")
