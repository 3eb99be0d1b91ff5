"""Giving a repaired text back to narrator and body: the cut nearest to the estimate for which the proof still holds.

Runs as an Arrow-batched function on proved rows only. A text is reduced once to the letters and digits between its
brackets, so cuts that differ by punctuation alone are one case, and each case is proved once.
"""

from __future__ import annotations

import re
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

REACH = 60
RESULT = "narrator string, body string, folded boolean"
_HONORIFICS = re.compile(T.HONORIFICS)
_OTHER = re.compile("[^a-z0-9]")
_SPAN = re.compile(r"\[[^\]]*\]")
_LINE_SPAN = re.compile(r"\[.*\]")
_TIDY = [(re.compile(pattern), new) for pattern, new in T.TIDY]
_JUNK = {"deletion": " :,-", "grouping": " \t\r\n):;,.-–]"}


def _letters(s: str) -> str:
    return _OTHER.sub("", s.lower())


def _key(s: str) -> str:
    return _HONORIFICS.sub("", _letters(s))


def _tidied(s: str) -> str:
    for pattern, new in _TIDY:
        s = pattern.sub(new, s)
    return s.strip()


def estimate(clean: str, narrator: str) -> int:
    """Length of the shortest prefix whose key is as long as the narrator's; 0 if there is none."""
    want = len(_key(narrator))
    seen = 0
    for end, c in enumerate(clean, 1):
        seen += len(_letters(c)) if want else 0
        if want and seen >= want and len(_key(clean[:end])) >= want:
            return end
    return 0


def _proof(way: str, target: str):
    """A test of texts, with a memory over the letters between brackets."""
    known: dict[tuple[str, ...], bool] = {}

    def deletion(s: str) -> bool:
        return _key(_LINE_SPAN.sub("", s)) == target

    def grouping(s: str) -> bool:
        parts = tuple(map(_letters, _SPAN.split(s)))
        if not 2 <= len(parts) <= T.MAX_PAIRS + 1:
            return False
        if parts not in known:
            inner = product(*(("", p) if p else ("",) for p in parts[1:-1]))
            known[parts] = any(_HONORIFICS.sub("", parts[0] + "".join(m) + parts[-1]) == target for m in inner)
        return known[parts]

    return deletion if way == "deletion" else grouping


def divide(clean: str, narrator: str, before: str, way: str) -> tuple[str | None, str | None, bool | None]:
    """(narrator, body, folded) of a clean text; nulls if the proof fails. Of two cuts equally far the earlier is taken.
    Without a cut that holds the narrator is folded into the body."""
    holds = _proof(way, _key(narrator + " " + before))
    if way == "grouping" and not holds(clean):
        return None, None, None
    at = estimate(clean, narrator)
    for cut in sorted(range(max(0, at - REACH), min(len(clean), at + REACH) + 1), key=lambda i: (abs(i - at), i)):
        body = clean[cut:].lstrip(_JUNK[way])
        if holds(narrator + " " + body):
            return narrator, _tidied(body), False
    if way == "deletion" and not holds(clean):
        return None, None, None
    body = _tidied(clean)
    return "", body.lstrip(_JUNK[way]) if way == "grouping" else body, narrator != ""


def restored(clean: Column, narrator: Column, before: Column, way: str) -> Column:
    """struct<narrator, body, folded>; way is `deletion` (brackets of a line deleted greedily) or `grouping` (groups of
    brackets deleted). Null texts count as empty, a null clean text gives nulls."""

    @F.pandas_udf(RESULT)
    def f(c: pd.Series, n: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [divide(x, y or "", z or "", way) if x is not None else (None, None, None) for x, y, z in zip(c, n, b)]
        return pd.DataFrame(rows, columns=["narrator", "body", "folded"])

    return f(clean, narrator, before)


def restore_rows(rows: DataFrame, matches: DataFrame, way: str) -> DataFrame:
    """rows (id, narrator, body) with their narrator and body restored from matches (id, clean), and status: `repaired`,
    `unprovable` (left as they are) or `untouched`. before holds the old body of a repaired row, for the log."""
    hits = rows.join(matches.select("id", "clean"), "id").withColumn("r", restored(F.col("clean"), F.col("narrator"), F.col("body"), way))
    hits = hits.select("id", "r")
    new = F.col("r.body").isNotNull()
    return rows.join(hits, "id", "left").select(
        "id",
        F.when(new, F.col("r.narrator")).otherwise(F.col("narrator")).alias("narrator"),
        F.when(new, F.col("r.body")).otherwise(F.col("body")).alias("body"),
        F.when(new, F.col("body")).alias("before"),
        F.when(new, F.col("r.folded")).alias("narrator_folded"),
        F.when(new, "repaired").when(F.col("r").isNotNull(), "unprovable").otherwise("untouched").alias("status"),
    )


def trim_logged(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Leading punctuation goes from the bodies of logged rows, unless nothing else is in them; others stay. rows: id, body,
    ...; log: id."""
    logged = log.select(F.col("id").alias("logged_id")).distinct()
    j = rows.join(logged, rows["id"] == F.col("logged_id"), "left")
    bare = T.trim_lead(F.col("body"))
    return j.withColumn("body", F.when(F.col("logged_id").isNotNull() & (bare != ""), bare).otherwise(F.col("body"))).drop("logged_id")
