"""Readers and writers of the collection's files: explicit schemas, never inference."""

from __future__ import annotations

import lzma

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import letters as A
from ..functions import marks as M
from ..functions import text as T

GRADES = "array<struct<name:string,grade:string>>"
SIDE = "struct<title:string,author:string,introduction:string>"
BOOK = f"id long, metadata struct<id:long,length:long,arabic:{SIDE},english:{SIDE}>, chapters array<struct<id:double,bookId:long,arabic:string,english:string>>, hadiths array<struct<id:long,idInBook:long,chapterId:double,bookId:long,citation:string,arabic:string,english:struct<narrator:string,text:string,grades:{GRADES}>>>"
CATALOG = "version long, description string, groups array<struct<key:string,title:string>>, books array<struct<slug:string,number:int,folder:string,group:string,groupTitle:string,englishTitle:string,arabicTitle:string,authorEnglish:string,authorArabic:string,era:string,shortDescription:string,longDescription:string,aliases:array<string>,chapters:int,hadiths:int>>"
LOG = "idInBook long, before string, after string, narrator_folded boolean, confirmed_by int, pass string"
DONOR_A = f"hadiths array<struct<hadithnumber:string,text:string,grades:{GRADES}>>"
MANIFEST = "formatVersion int, foldFingerprint string, blockedWordFingerprint string, blockTargetBytes long, textCodec string, searchCodec string, totalChapters long, totalHadiths long, totalPackBytes long, books array<struct<slug:string,bytes:long,sourceBytes:long,chapters:long,hadiths:long,dailyCandidates:long,blocks:long,sha256:string>>"
_ENTRY = "title:string,intro:string,body:string,explanation:string,benefits:array<string>"
ARABIC_ENTRY, ENGLISH_ENTRY = f"struct<{_ENTRY},words:array<struct<w:string,m:string>>,attribution:string,grade:string,reference:string>", f"struct<{_ENTRY},attribution:string,grade:string>"
ENCYCLOPEDIA = "tree array<struct<id:string,parent:string,labels:struct<en:string,ar:string>,direct:int,total:int>>, index array<struct<id:string,cats:array<string>>>"
DONOR_B = "english string, arabic string, reference string, grade string"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path).withColumn("slug", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.(?:repairlog\.)?json$", 1))


def read_books(spark: SparkSession, path: str, slugs: list[str] | None = None) -> DataFrame:
    books = _json(spark, path, BOOK)
    return books if slugs is None else books.filter(F.col("slug").isin(slugs))


def records(books: DataFrame) -> DataFrame:
    """A row for each record; row is its place in the book."""
    return books.select("slug", F.posexplode("hadiths").alias("row", "h")).select("slug", "row", "h.id", "h.idInBook", M.chapter_number(F.col("h.chapterId")).alias("chapter"), "h.citation", M.citation_base(F.col("h.citation")).alias("citation_base"), M.citation_suffix(F.col("h.citation")).alias("citation_suffix"), "h.arabic", "h.english.narrator", "h.english.text", "h.english.grades")


def chapters(books: DataFrame) -> DataFrame:
    return books.select("slug", F.explode("chapters").alias("c")).select("slug", M.chapter_number(F.col("c.id")).alias("chapter"), "c.arabic", "c.english")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG).option("multiLine", True).json(path).select(F.explode("books").alias("b")).select("b.*")


def in_catalog_order(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """rows (slug, row, ...) with number, the book's in the catalogue, and position, the row's place when books follow each
    other by number; books that the catalogue lacks are left out."""
    sizes = rows.groupBy("slug").agg(F.count("*").alias("n")).join(catalog.select("slug", "number"), "slug")
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # one number for each book
    starts = sizes.select(F.col("slug").alias("of_slug"), "number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, F.col("slug") == F.col("of_slug")).withColumn("position", F.col("start") + F.col("row")).drop("of_slug", "start")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each book of a manifest, with what holds for all of them."""
    m = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    return m.select(*(c for c in m.columns if c != "books"), F.explode("books").alias("b")).select(*(c for c in m.columns if c != "books"), "b.*")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """One row: vectors, the whole JSON of expected values as a variant; take parts by ``variant_get``."""
    return spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("vectors"))


def read_encyclopedia(spark: SparkSession, path: str, name: str) -> DataFrame:
    """core (id, arabic), tr-en (id, english), or of catalog its tree (id, parent, labels, direct, total) or index (id,
    categories), by name; the files are JSON, and compressed ones must be unpacked first."""
    side = {"core": ("arabic", ARABIC_ENTRY), "tr-en": ("english", ENGLISH_ENTRY)}
    if name in side:
        out, schema = side[name]
        text = spark.read.text(f"{path}/{name}.json", wholetext=True)
        return text.select(F.explode(F.from_json("value", f"map<string,{schema}>")).alias("id", out))
    catalog = spark.read.schema(ENCYCLOPEDIA).option("multiLine", True).json(f"{path}/catalog.json").select(F.explode(name).alias("x"))
    if name == "tree":
        return catalog.select("x.id", "x.parent", "x.labels", F.coalesce("x.direct", F.lit(0)).alias("direct"), F.coalesce("x.total", F.lit(0)).alias("total"))
    return catalog.select("x.id", F.coalesce("x.cats", F.array().cast("array<string>")).alias("categories"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, LOG)


def read_donor_a(spark: SparkSession, path: str) -> DataFrame:
    """Text and gradings with a verdict; entries without text are left out."""
    d = _json(spark, path, DONOR_A).select("slug", F.posexplode("hadiths").alias("position", "h")).filter("trim(h.text) <> ''")
    trimmed = F.transform(F.coalesce("h.grades", F.array().cast(GRADES)), lambda g: F.struct(F.trim(g["name"]).alias("name"), F.trim(g["grade"]).alias("grade")))
    return d.select("slug", "position", "h.hadithnumber", "h.text", F.filter(trimmed, lambda g: g["grade"] != "").alias("grades"))


def read_donor_b(spark: SparkSession, path: str, only: str | None = None) -> DataFrame:
    """Files with a byte order mark, or the one file named only. row is a row's place in book order: files by the leading
    number of their names (none: 0) and then by name. A file that is no JSON array has one row, without anything but its name
    and its text in corrupt."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", only or "*.json").text(path, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    parsed = F.from_json(F.regexp_replace("value", "^\ufeff", ""), f"array<struct<{DONOR_B.replace(' ', ':')}>>".replace(",:", ","))
    number = F.coalesce(F.regexp_extract("file", r"^(\d+)", 1).try_cast("int"), F.lit(0))
    files = raw.select(number.alias("file_number"), "file", F.when(parsed.isNull(), F.col("value")).alias("corrupt"), parsed.alias("rows"))
    before = Window.orderBy("file_number", "file").rowsBetween(Window.unboundedPreceding, -1)  # one number for each file
    starts = files.select("file_number", "file", F.coalesce(F.size("rows"), F.lit(0)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).select(F.col("file").alias("of_file"), "start")
    d = files.select("file_number", "file", "corrupt", F.posexplode_outer("rows").alias("position", "r")).join(starts, F.col("file") == F.col("of_file"))
    return d.select("file_number", "file", "position", (F.col("start") + F.col("position")).alias("row"), "r.*", M.parse_grade(F.col("r.grade")).alias("parsed_grade"), "corrupt")


def donor_numbers(rows: DataFrame, least: int = 40) -> DataFrame:
    """(slug, key, number) of the donor texts whose key has at least ``least`` letters and one number. rows: slug, text,
    hadithnumber."""
    key = T.norm_key(F.col("text"))
    d = rows.select("slug", key.alias("key"), F.col("hadithnumber").try_cast("int").alias("number")).filter(F.length("key") >= least)
    return d.groupBy("slug", "key").agg(F.min("number").alias("number"), F.max("number").alias("other")).filter("number = other").drop("other")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-case words; blank lines and lines that begin with # are left out. Files may be compressed by xz."""

    def lines(batches):
        for pdf in batches:
            for blob in pdf["content"]:
                yield pd.DataFrame({"value": lzma.decompress(bytes(blob)).decode().split("\n")})

    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "value string") if path.endswith(".xz") else spark.read.text(path)
    return raw.select(F.lower(F.trim("value")).alias("word")).filter("word <> '' and not startswith(word, '#')").distinct()


def read_catalog_literals(spark: SparkSession, path: str, type_name: str, fields: list[str]) -> DataFrame:
    """(position, group, fields, aliases) of the literals `type_name( name: "value", group: .name, aliases: [...] )` in source
    text, each literal on lines of its own. A field that a literal lacks is null."""
    text = spark.read.text(path, wholetext=True)
    literal = rf"(?s){type_name}\(\s*\n(.*?)\n\s*\),?(?:\n|$)"
    one = text.select(F.posexplode(F.regexp_extract_all("value", F.lit(literal), F.lit(1))).alias("position", "x"))
    quoted = r'"((?:[^"\\]|\\.)*)"'
    listed = F.regexp_extract("x", r"(?s)aliases:\s*\[(.*?)\]", 1)
    return one.select(
        "position",
        F.regexp_extract("x", r"group:\s*\.(\w+)", 1).alias("group"),
        *(F.when(F.col("x").rlike(rf"\b{f}:\s*{quoted}"), A.unescape(F.regexp_extract("x", rf"\b{f}:\s*{quoted}", 1))).alias(f) for f in fields),
        F.regexp_extract_all(listed, F.lit(quoted), F.lit(1)).alias("aliases"),
    )


def write_pack(rows: DataFrame, path: str, partitions: int = 16) -> None:
    """The physical layout of a collection: sorted by (book, row) in ranges, so a chapter is a slice that row-group
    statistics find; text columns compressed by zstd."""
    rows.repartitionByRange(partitions, "slug", "row").sortWithinPartitions("slug", "row").write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_book_json(books: DataFrame, path: str) -> None:
    """One line of JSON for each book, null fields left out."""
    books.select("slug", F.to_json(F.struct(*(c for c in books.columns if c != "slug"))).alias("value")).write.mode("overwrite").partitionBy("slug").text(path)


def chapter_slice(rows: DataFrame, slug: str, first_row: int, n_rows: int) -> DataFrame:
    return rows.filter((F.col("slug") == slug) & F.col("row").between(first_row, first_row + n_rows - 1))


def row_for(rows: DataFrame, slug: str, id_in_book: int) -> DataFrame:
    """The first row of a book with that number, if any."""
    return rows.filter((F.col("slug") == slug) & (F.col("idInBook") == id_in_book)).orderBy("row").limit(1)


def of_chapter(rows: DataFrame, slug: str, chapter: int) -> DataFrame:
    return rows.filter((F.col("slug") == slug) & (F.col("chapter") == chapter))


def write_log(log: DataFrame, path: str) -> None:
    """A folder for each book with a line of JSON for each entry, by number. log: slug, idInBook, ..."""
    own = [c for c in log.columns if c != "slug"]
    lines = log.select("slug", "idInBook", F.to_json(F.struct(*own)).alias("value"))
    lines.repartitionByRange("slug", "idInBook").sortWithinPartitions("slug", "idInBook").drop("idInBook").write.mode("overwrite").partitionBy("slug").text(path)


def write_corpora(path: str, words: DataFrame | None = None, **tables: DataFrame) -> None:
    """Derived corpora below path: words as sorted text, a word a line, and each other table as JSON lines in its order."""
    if words is not None:
        words.select("word").distinct().orderBy("word").write.mode("overwrite").text(f"{path}/vocabulary")
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
