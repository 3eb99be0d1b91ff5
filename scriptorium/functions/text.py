"""Column functions over text: folds, white space, keys, brackets, fingerprints. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the search folds and of the matching keys.
WHITE_SPACE = r"\t\n\x0B\f\r\x{85}\x{2028}\x{2029} \x{A0}\x{1680}\x{202F}\x{205F}\x{3000}\x{2000}-\x{200A}"
ARABIC_FROM = "ٰٱأإآٲٳٵؤئٶٷٸۥۦىةءٴ"
ARABIC_TO = "ااااااااويوويوياه"
ARABIC_SCRIPT = r"[\x{600}-\x{6FF}\x{750}-\x{77F}\x{8A0}-\x{8FF}]"
ARABIC_SIGNS = r"[\x{64B}-\x{65F}\x{6D6}-\x{6ED}\x{670}\x{674}]"
MATCH_MARKS = r"[\x{610}-\x{61A}\x{64B}-\x{65F}\x{670}\x{640}\x{6D6}-\x{6ED}]"
MATCH_FROM, MATCH_TO = "أإآٱىةؤئء", "اااااهوي"
HONORIFICS = "maytheblessingsandpeaceofallahbeuponhim|peaceandblessingsofallahbeuponhim|mayallahbepleasedwithhim|pbuh|saw|onwhombepeace|peacebeuponhim|chapter|verse"
#: The same, tried only where its first two letters can be: most letters of a key are none of these.
_HONORIFICS = f"(?=[mpsocv][aebhn])(?:{HONORIFICS})"
BLESSING = "ﷺ"
SPELLED_BLESSING = "صلى\\s+الله\\s+عليه\\s+و\\s*سلم"
MAX_PAIRS = 12
TIDY = [
    (rf"\(\s*{BLESSING}\s*\)\s*{BLESSING}", BLESSING),
    (rf"{BLESSING}\s*\(\s*{BLESSING}\s*\)", BLESSING),
    (SPELLED_BLESSING, BLESSING),
    (rf"\(\s*{BLESSING}\s*\)", f"({BLESSING})"),
    ("[ \t]{2,}", " "),
]


def fold_english(s: Column) -> Column:
    """Punctuation, symbols and marks dropped, lower case; white space stays as it is."""
    return F.lower(F.regexp_replace(s, r"[\p{P}\p{S}\p{M}]+", ""))


def fold_arabic(s: Column) -> Column:
    kept = F.regexp_replace(F.translate(s, ARABIC_FROM, ARABIC_TO), r"[\p{P}\p{S}\p{M}&&[^&|!#]]", "")
    spaced = F.regexp_replace(F.lower(kept), f"[{WHITE_SPACE}]+", " ")
    return F.regexp_replace(F.trim(spaced), ARABIC_SIGNS, "")


def is_arabic(s: Column) -> Column:
    return s.rlike(ARABIC_SCRIPT)


def fold_query(raw: Column) -> Column:
    t = F.regexp_replace(raw, f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")
    return F.when(is_arabic(t), fold_arabic(t)).otherwise(fold_english(t))


def clean_text(s: Column) -> Column:
    """Paragraph breaks stay as two line feeds, other white space becomes one space; a text without any is left alone."""
    t = F.regexp_replace(F.regexp_replace(s, "\r\n?", "\n"), "[\t\u00a0]", " ")
    t = F.regexp_replace(F.regexp_replace(t, " *\n *", "\n"), "\n{2,}", "\u2029")
    t = F.regexp_replace(F.regexp_replace(t, "\n", " "), " {2,}", " ")
    t = F.regexp_replace(t, " ?\u2029 ?", "\n\n")
    t = F.regexp_replace(t, f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")
    return F.when(s.rlike("[\n\t\r\u00a0]|  "), t).otherwise(s)


def norm_key(s: Column) -> Column:
    """Lower-case ASCII letters and digits without honorifics: equal keys mean the same words."""
    return F.regexp_replace(F.regexp_replace(F.lower(s), "[^a-z0-9]+", ""), _HONORIFICS, "")


def digest(key: Column) -> Column:
    """The MD5 of a key: what stands for it where keys are only compared for equality."""
    return F.md5(key.cast("binary"))


def tidy(s: Column) -> Column:
    for pattern, new in TIDY:
        s = F.regexp_replace(s, pattern, new)
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def greedy_strip(s: Column) -> Column:
    """What a greedy bracket deletion leaves of each line."""
    return F.regexp_replace(s, r"(?d)\[.*\]", "")


def looks_scarred(s: Column) -> Column:
    return s.rlike(r"[a-zA-Z\)\]\"\u201d]\s+[.,:;]|[a-z]  +[a-zA-Z]")


def bracket_spans(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(r"(\[[^\]]*\])"), F.lit(1))


def bracket_segments(s: Column) -> Column:
    return F.split(s, r"\[[^\]]*\]", -1)


def strip_grouped(segments: Column, kept: Column) -> Column:
    """Segments joined; inner segment j (from 1) stays if bit j - 1 of kept is set, the outer ones always."""
    last = F.size(segments) - 1
    inside = lambda x, j: (j == 0) | (j == last) | (F.getbit(kept.cast("long"), F.greatest(j - 1, F.lit(0))) == 1)
    return F.array_join(F.filter(segments, inside), "")


def provable(clean: Column, target_key: Column) -> Column:
    """Whether some way to delete groups of consecutive brackets from clean gives the target key."""
    segments = bracket_segments(clean)
    k = F.size(segments) - 1
    ways = F.sequence(F.lit(0), (F.pow(F.lit(2), F.least(k, F.lit(MAX_PAIRS)) - 1) - 1).cast("int"))
    return F.when((k < 1) | (k > MAX_PAIRS), F.lit(False)).otherwise(F.exists(ways, lambda m: norm_key(strip_grouped(segments, m)) == target_key))


def grouping_digests(clean: Column) -> Column:
    """The digest of each key that some grouping of the brackets of clean gives; empty without brackets or with too many."""
    segments = F.transform(bracket_segments(clean), lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]+", ""))

    def given(parts: Column) -> Column:
        k = F.size(parts) - 1
        ways = F.sequence(F.lit(0), (F.pow(F.lit(2), F.greatest(F.least(k, F.lit(MAX_PAIRS)), F.lit(1)) - 1) - 1).cast("int"))
        made = F.transform(ways, lambda m: digest(F.regexp_replace(strip_grouped(parts, m), _HONORIFICS, "")))
        return F.when(F.coalesce((k < 1) | (k > MAX_PAIRS), F.lit(True)), F.array().cast("array<string>")).otherwise(F.array_distinct(made))

    # the segments are bound to a name, or each way would make them anew
    return F.element_at(F.transform(F.array(segments), given), 1)


def trim_lead(s: Column) -> Column:
    return F.regexp_replace(s, "^[ \t\r\n):;,.\\-\u2013\\]]+", "")


def match_fold(s: Column) -> Column:
    """Base Arabic letters only, for matching rows of two sources."""
    t = F.translate(F.regexp_replace(F.coalesce(s, F.lit("")), MATCH_MARKS, ""), MATCH_FROM, MATCH_TO)
    return F.regexp_replace(t, r"[^\x{621}-\x{64A}]", "")


def graphemes(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"\X"))


def has_blocked_word(s: Column, words: list[str]) -> Column:
    return F.arrays_overlap(F.split(F.lower(s), r"[^\p{L}]+"), F.array(*map(F.lit, words)))


def daily_candidate(arabic: Column, body: Column, narrator: Column, words: list[str], longest: int = 220) -> Column:
    """Whether a record is short in both languages, has a text and none of the blocked words in it or its narrator."""
    short = (graphemes(F.coalesce(arabic, F.lit(""))) <= longest) & (graphemes(body) <= longest)
    return F.coalesce((body != "") & short & ~has_blocked_word(F.concat_ws(" ", body, narrator), words), F.lit(False))


def describe(s: Column, n: int) -> Column:
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


def fnv1a(s: Column) -> Column:
    """64-bit FNV-1a of the UTF-8 bytes, 16 hexadecimal digits; kept as two 32-bit halves, so nothing overflows."""
    low32 = F.lit((1 << 32) - 1)
    start = F.struct(F.lit(3421674724).alias("hi"), F.lit(2216829733).alias("lo"))
    digits = F.hex(F.encode(s, "utf-8"))
    octets = F.when(F.length(s) == 0, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(1), F.octet_length(s)), lambda i: F.conv(F.substring(digits, 2 * i - 1, F.lit(2)), 16, 10).cast("long")))

    def step(acc, b):
        x = acc["lo"].bitwiseXOR(b)
        hi = (acc["hi"] * 435 + F.shiftleft(x.bitwiseAND(F.lit(16777215)), 8) + F.shiftright(x * 435, 32)).bitwiseAND(low32)
        return F.struct(hi.alias("hi"), (x * 435).bitwiseAND(low32).alias("lo"))

    half = lambda c: F.lpad(F.lower(F.hex(c)), 8, "0")
    return F.aggregate(octets, start, step, lambda a: F.concat(half(a["hi"]), half(a["lo"])))


def vocabulary_words(fold: Column) -> Column:
    """Words of 4 to 24 letters a to z."""
    return F.filter(F.split(fold, f"[{WHITE_SPACE}\\x{{1C}}-\\x{{1F}}]+"), lambda w: w.rlike(r"^[a-z]{4,24}\z"))


def semantic_words(s: Column) -> Column:
    return F.regexp_extract_all(F.lower(s), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


# Texts whose folds stand for both folds.
PROBES = [
    "إنَّمَا الْأَعْمَالُ بِالنِّيَّاتِ",
    "قَالَ رَسُولُ اللَّهِ ﷺ",
    "ٱلْحَمْدُ لِلَّهِ رَبِّ ٱلْعَٰلَمِينَ",
    "الصَّلَاةُ خَيْرٌ مِنَ النَّوْمِ",
    "أَبُو هُرَيْرَةَ، ؤ، ئ، ء، ٱ، ى، ة، ٰ",
    "مَنْ كَانَ يُؤْمِنُ بِاللَّهِ وَالْيَوْمِ الْآخِرِ",
    "Narrated 'A'ishah (may Allah be pleased with her):",
    'The Messenger of Allah (ﷺ) said: "Actions are (judged) by motives (niyyah)"',
    "Mu'adh ibn Jabal - [of His] - Abu Dawud 1:23",
    "  doubled   spaces\tand\ttabs\nand\nnewlines  ",
    "MiXeD CaSe, punctuation!? and symbols +=%$#@ and digits 0123456789",
    "",
]


def fold_fingerprint() -> Column:
    """One value for both folds: the fingerprint of all probes through them. It needs no column."""
    return fnv1a(F.concat(*(F.concat(fold_arabic(F.lit(p)), F.lit("\x01"), fold_english(F.lit(p)), F.lit("\x02")) for p in PROBES)))


def word_list_fingerprint(words: Column) -> Column:
    """The fingerprint of an array of words, whatever their order and case."""
    return fnv1a(F.array_join(F.array_sort(F.transform(words, F.lower)), "\n"))
