"""Column functions over gradings, citations and chapter numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of gradings, reference lines and topic references.
ARABIC_LETTER = r"[\x{600}-\x{6FF}\x{750}-\x{77F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
GRADE_PREFIX = r"(?i)^\s*Grade\s*:\s*"
TRAILING_NAME = r"\(([^()]{2,40})\)\s*$"
REFERENCE_SEGMENT = r"(?s)Reference\s*:\s*(.*?)\s*(?:(?:In-book|Sunnah\.com|USC-MSA[^:]*|English|Arabic(?:/English)?)\s*(?:reference|translation|book reference)|$)"
NUMBER = r"(\d+)\s*([a-z])?(?![\w])"
BOOK_NUMBER = r"Arabic/English book reference\s*:\s*Book\s*\d+,\s*Hadith\s*(\d+)"
ARABIC_NUMBER = r"Arabic reference\s*:\s*Book\s*\d+,\s*Hadith\s*(\d+)"
TOPIC_ADDRESS, TOPIC_ID = r"^https://sunnah\.com/([a-z]+):(\d+[a-z]?)$", r"^([a-z]+)-(\d+[a-z]?)$"
RECORD, UNIT = "\u001e", "\u001f"
VERDICTS = "(?i)sahih|sah\u012bh|hasan|da'if|da\u2019if|da'eef|daif|d[ae]'?[ei]f|isnad|isn\u0101d|mauquf|munkar|mursal|shadh|matruk|maudu|no basis|corroborat|weakness|interrupted|unknown|qawi|lighairihi|li ghairihi"


def let(x: Column, f) -> Column:
    """f(x) with x worked out once, however often f names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _strip(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def chapter_number(v: Column) -> Column:
    """A whole number stays, a fraction x becomes 1000 + round(10 x), a bad value 0."""
    x = v.try_cast("double")
    return F.when(x.isNull() | F.isnan(x), 0).when(x == F.floor(x), x.try_cast("int")).otherwise((1000 + F.rint(x * 10)).try_cast("int"))


def citation_base(c: Column) -> Column:
    return F.coalesce(F.regexp_extract(c, r"^(\d+)[a-z]?$", 1).try_cast("int"), F.lit(0))


def citation_suffix(c: Column) -> Column:
    s = F.regexp_extract(c, r"^\d+([a-z])$", 1)
    return F.when(F.coalesce(s, F.lit("")) == "", 0).otherwise(F.ascii(s) - 96).cast("int")


def encode_grades(grades: Column) -> Column:
    """array<struct<name, grade>> as one string; entries without a verdict are left out."""
    edge = r"^[\t\p{Zs}]+|[\t\p{Zs}]+$"
    t = F.transform(F.coalesce(grades, F.array().cast("array<struct<name:string,grade:string>>")), lambda g: F.struct(F.regexp_replace(F.coalesce(g["name"], F.lit("")), edge, "").alias("name"), F.regexp_replace(F.coalesce(g["grade"], F.lit("")), edge, "").alias("grade")))
    return F.array_join(F.transform(F.filter(t, lambda g: g["grade"] != ""), lambda g: F.concat(g["name"], F.lit(UNIT), g["grade"])), RECORD)


def decode_grades(s: Column) -> Column:
    parts = F.filter(F.split(s, RECORD), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(F.split_part(x, F.lit(UNIT), F.lit(1)).alias("name"), F.split_part(x, F.lit(UNIT), F.lit(2)).alias("grade")))


def parse_grade(raw: Column) -> Column:
    """struct<name, grade> of "Grade : verdict (name)"; null without the prefix or a verdict."""
    text = _strip(F.regexp_replace(F.regexp_replace(raw, GRADE_PREFIX, ""), f"(?s){ARABIC_LETTER}.*$", ""))
    name = F.regexp_extract(text, TRAILING_NAME, 1)
    out = F.struct(_strip(name).alias("name"), F.when(name == "", text).otherwise(_strip(F.regexp_replace(text, TRAILING_NAME, ""))).alias("grade"))
    return F.when(raw.rlike(GRADE_PREFIX) & (text != ""), out)


def parse_citation(slug: Column, raw: Column) -> Column:
    """A reference line's citation as text, null if it has none."""
    number = lambda s, p, g=1: F.nullif(F.regexp_extract(s, p, g), F.lit(""))
    segment = F.regexp_extract(raw, REFERENCE_SEGMENT, 1)
    main = F.when(segment.rlike(NUMBER), F.concat(F.regexp_extract(segment, NUMBER, 1), F.regexp_extract(segment, NUMBER, 2)))
    adab = F.when(slug == "aladab_almufrad", number(raw, BOOK_NUMBER))
    return F.when(slug == "darimi", number(raw, ARABIC_NUMBER)).when(slug != "malik", F.coalesce(main, adab))


def topic_reference(url: Column, own_id: Column, part: int) -> Column:
    """Book (part 1) or citation (part 2) of a topic entry, from its address or else its id; null if neither names one."""
    a = F.regexp_extract(F.coalesce(url, F.lit("")), TOPIC_ADDRESS, part)
    b = F.regexp_extract(own_id, TOPIC_ID, part)
    return F.nullif(F.when(a != "", a).otherwise(b), F.lit(""))


def drop_unmatched(s: Column, opening: str, closing: str, close_open: bool) -> Column:
    """Unmatched closing marks go; unmatched opening marks are closed at the end, before a full stop, or go as well."""
    chars = F.split(s, "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("open"))
    fwd = F.aggregate(chars, start, lambda a, c: F.struct(F.when((c == closing) & (a["open"] == 0), a["out"]).otherwise(F.concat(a["out"], c)).alias("out"), (a["open"] + F.when(c == opening, 1).when((c == closing) & (a["open"] > 0), -1).otherwise(0)).alias("open")))
    return let(fwd, lambda f: _close(f, opening, closing, close_open, start))


def _close(fwd: Column, opening: str, closing: str, close_open: bool, start: Column) -> Column:
    if close_open:
        body = F.regexp_replace(fwd["out"], r"\s+$", "")
        tail = F.regexp_extract(body, r"([. ]*)$", 1)
        closed = F.concat(F.regexp_replace(body, r"[. ]+$", ""), F.repeat(F.lit(closing), fwd["open"]), _strip(tail))
        return F.when(fwd["open"] > 0, closed).otherwise(fwd["out"])
    back = F.aggregate(F.reverse(F.split(fwd["out"], "")), start, lambda a, c: F.struct(F.when((c == opening) & (a["open"] == 0), a["out"]).otherwise(F.concat(c, a["out"])).alias("out"), (a["open"] + F.when(c == closing, 1).when((c == opening) & (a["open"] > 0), -1).otherwise(0)).alias("open")))
    return back["out"]


def tidy_spacing(s: Column, original: Column) -> Column:
    """Cleans what a cut left, never what the original had."""
    t = F.regexp_replace(F.regexp_replace(s, r"\(\s*\)", ""), r"\[\s*\]", "")
    t = F.regexp_replace(_strip(F.regexp_replace(t, r"\s{2,}", " ")), r"\s+([,;])", "$1")
    t = let(t, lambda x: F.when(original.rlike(r"[\s,;]+$"), x).otherwise(F.regexp_replace(x, r"[\s,;]+$", "")))
    return _strip(let(t, lambda x: F.when(original.rlike(r"^[\s,;:.\]\)\}]"), x).otherwise(F.regexp_replace(x, r"^[\s,;:.\]\)\}]+", ""))))


def _parts(s: Column) -> Column:
    return F.transform(F.split(s, ","), _strip)


def has_repeated_part(s: Column) -> Column:
    full = F.filter(_parts(s), lambda p: p != "")
    return F.size(F.array_distinct(full)) < F.size(full)


def collapse_repeated_parts(s: Column) -> Column:
    """Exact repeats of a comma-separated part go; empty parts stay."""
    parts = _parts(s)
    kept = F.filter(parts, lambda p, i: (p == "") | (F.array_position(parts, p) == i + 1))
    return F.when(F.size(kept) < F.size(parts), F.array_join(kept, ", ")).otherwise(s)


def has_artifact(grade: Column, name: Column) -> Column:
    brackets = F.length(grade) - F.length(F.replace(grade, F.lit("["))) != F.length(grade) - F.length(F.replace(grade, F.lit("]")))
    own = (F.coalesce(name, F.lit("")) != "") & F.coalesce(F.contains(grade, F.concat(F.lit("("), name, F.lit(")"))), F.lit(False))
    return own | grade.rlike(r"\b[Ll]ts\b") | grade.rlike(r"\\+['\"]") | brackets | has_repeated_part(grade)


def repair_grade(grade: Column, name: Column) -> Column:
    """The grade without its artifacts; unchanged if it has none, null if the repair would lose the verdict."""
    count = lambda s, c: F.length(s) - F.length(F.replace(s, F.lit(c)))
    own = F.coalesce(name, F.lit(""))
    out = F.when(own != "", F.replace(grade, F.concat(F.lit("("), own, F.lit(")")), F.lit(" "))).otherwise(grade)
    out = F.regexp_replace(F.regexp_replace(out, r"\bLts\b", "Its"), r"\blts\b", "its")
    out = drop_unmatched(F.regexp_replace(out, r"\\+(['\"])", "$1"), "[", "]", True)
    out = let(out, lambda t: F.when(count(t, "(") != count(t, ")"), drop_unmatched(t, "(", ")", False)).otherwise(t))
    out = let(out, lambda t: F.when(count(t, "}") > count(t, "{"), F.replace(t, F.lit("}"), F.lit(""))).otherwise(t))
    out = let(let(out, lambda t: tidy_spacing(t, grade)), collapse_repeated_parts)
    checked = let(out, lambda t: F.when((t != "") & (t.rlike(VERDICTS) | ~grade.rlike(VERDICTS)), t))
    return F.when(has_artifact(grade, name), checked).otherwise(grade)
