"""Alignment of a book's rows with a donor's rows, tier by tier: equal folds, equal or proved translations, runs, positions,
prefixes. Candidates are found by joins on keys; only the choice among them is sequential, because an earlier row may take
what a later one wants. It runs on candidate pairs of a few integers each, a book at a time.

rows: book, row, fold, narrator, text. donors: book, donor (0, 1, ...), fold, english. A null text counts as empty.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..store import materialise
from .linkage import Keys, align_groups, fingerprint, proved_in_window
from .ordered import steady_runs, with_neighbours

PREFIX, LEAST_FOLD = 48, 24
PAIRS = "book string, row long, donor long"


def fold_tiers(rows: DataFrame, donors: DataFrame) -> DataFrame:
    """(book, row, donor, tier): T1 where a fold occurs once on each side, T2 where it occurs equally often."""
    p = align_groups(rows.filter("fold <> ''"), donors.filter("fold <> ''").withColumnRenamed("donor", "row"))
    return p.select("book", "row", "donor", F.when(F.col("n") == 1, "T1").otherwise("T2").alias("tier"))


def _shortened(rows: DataFrame, donors: DataFrame, save) -> tuple[DataFrame, DataFrame]:
    """What the tiers need of rows and donors, stored: a digest of each fold ('' if it is empty) and its prefix, and the
    fingerprints of the texts' keys. Texts are read once for each side and never move."""
    text, blank = F.coalesce("text", F.lit("")), f"^[{T.WHITE_SPACE}]*$"
    fold = [F.when(F.col("fold") == "", "").otherwise(T.digest(F.col("fold"))).alias("fold"), F.substring("fold", 1, PREFIX).alias("prefix")]
    keys = F.array(*(F.struct(*fingerprint(k)) for k in _row_keys()))
    a = rows.select("book", "row", *fold, text.rlike(blank).alias("blank"), keys.alias("keys"))
    english = T.norm_key(F.col("english"))
    b = donors.select("book", "donor", *fold, F.coalesce(F.col("english").rlike(blank), F.lit(True)).alias("blank"), *fingerprint(english), T.grouping_digests(F.col("english")).alias("ways"))
    return save(a, "rows"), save(b, "donors")


def _row_keys() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [T.norm_key(F.concat(F.coalesce("narrator", F.lit("")), F.lit(" "), text)), T.norm_key(text)]


def translation_candidates(rows: DataFrame, donors: DataFrame, row_keys: Keys, donor_keys: Keys) -> DataFrame:
    """(book, row, k, proof, donor, n): donors whose key equals a row's k-th key (0: narrator and text, 1: text), or from
    which that key can be proved. n counts the donors with the same key; donor is the first of them. rows and donors as
    ``_shortened`` makes them; row_keys and donor_keys as for
    ``proved_in_window``."""
    groups = donors.filter("not blank").groupBy("book", "key", "head").agg(F.min("donor").alias("donor"), F.count("*").alias("n"), F.min_by("ways", "donor").alias("ways"))
    groups = materialise(groups, "english")
    wanted = rows.filter("not blank").select("book", "row", F.posexplode("keys").alias("k", "x")).select("book", "row", "k", "x.key", "x.head", (F.col("row") * 2 + F.col("k")).alias("id"))
    met = materialise(wanted.join(groups.select("book", "key", "donor", "n"), ["book", "key"], "left"), "wanted")
    exact = met.filter("n is not null").select("book", "row", "k", F.lit(False).alias("proof"), "donor", "n")
    # a key that several donors share is refused, so it needs no proof
    open_keys = met.filter("n is null or n = 1").select("book", "id", "key", "head")
    found = proved_in_window(open_keys, groups.select("book", "key", "head", "ways"), row_keys, donor_keys).select("book", "id", F.col("given").alias("key"))
    proved = found.join(groups.select("book", "key", "donor", "n"), ["book", "key"]).select("book", F.floor(F.col("id") / 2).alias("row"), (F.col("id") % 2).cast("int").alias("k"), F.lit(True).alias("proof"), "donor", "n")
    return exact.unionByName(proved)


def choose_translations(pairs: pd.DataFrame) -> pd.DataFrame:
    """The donor of each row, rows in order. For each key: the one donor with it; if none is free, the one donor from which
    it is proved; two donors with the key end the row's search."""
    taken: set[int] = set()
    out = []
    for row, own in pairs.sort_values(["row", "k"]).groupby("row", sort=True):
        for _, tries in own.groupby("k", sort=True):
            exact, proved = tries[~tries["proof"]], tries[tries["proof"]]
            if (exact["n"] > 1).any():
                break
            free = [d for d in exact["donor"].tolist() if d not in taken]
            if not free and len(proved) == 1 and proved["n"].iloc[0] == 1:
                free = [d for d in proved["donor"].tolist() if d not in taken]
            if free:
                taken.add(free[0])
                out.append((own["book"].iloc[0], row, free[0]))
                break
    return pd.DataFrame(out, columns=["book", "row", "donor"])


def translation_tier(rows: DataFrame, donors: DataFrame, row_keys: Keys, donor_keys: Keys) -> DataFrame:
    """T3 of the rows and donors that are still open."""
    found = translation_candidates(rows, donors, row_keys, donor_keys).groupBy("book").applyInPandas(choose_translations, PAIRS)
    return found.withColumn("tier", F.lit("T3"))


def position_tier(rows: DataFrame, pairs: DataFrame, donors: DataFrame) -> DataFrame:
    """T4: k open rows between anchors whose donors are k + 1 apart get the donors between, if all are free. The ends of a
    book are anchors too, but a book without a pair gets none. Of gaps that claim a donor twice the first one gets it."""
    sizes = donors.groupBy("book").agg(F.max("donor").alias("__last"))
    ends = rows.groupBy("book").agg(F.max("row").alias("__end")).join(sizes, "book")
    d = rows.select("book", "row").join(pairs.select("book", "row", "donor"), ["book", "row"], "left").withColumn("anchor", F.when(F.col("donor").isNotNull(), F.col("row")))
    d = with_neighbours(d, "book", "row", {"lo": "donor", "lr": "anchor"}, {"hi": "donor", "hr": "anchor"}).filter("donor is null and (lr is not null or hr is not null)").join(ends, "book")
    start, from_row = F.coalesce("lo", F.lit(-1)), F.coalesce("lr", F.lit(-1))
    stop, to_row = F.coalesce("hi", F.col("__last") + 1), F.coalesce("hr", F.col("__end") + 1)
    claims = d.filter(stop - start == to_row - from_row).select("book", "row", from_row.alias("gap"), (start + F.col("row") - from_row).alias("donor"))
    used = pairs.select("book", "donor").withColumn("used", F.lit(True))
    first = claims.groupBy("book", "donor").agg(F.min("gap").alias("first"))
    judged = claims.join(first, ["book", "donor"]).join(used, ["book", "donor"], "left")
    bad = judged.filter("used or gap <> first").select("book", "gap").distinct()
    return claims.join(bad, ["book", "gap"], "left_anti").select("book", "row", "donor", F.lit("T4").alias("tier"))


def choose_prefixes(pairs: pd.DataFrame) -> pd.DataFrame:
    """The donor of each row, rows in order, if exactly one is free between its neighbours' donors. A choice is the left
    neighbour of the rows after it in its gap."""
    taken: set[int] = set()
    out, left = [], {}
    for row, own in pairs.sort_values(["row", "donor"]).groupby("row", sort=True):
        gap = own["gap"].iloc[0]
        at = left.get(gap, own["lo"].iloc[0])
        free = [d for d in own["donor"].tolist() if at < d < own["hi"].iloc[0] and d not in taken]
        if len(free) == 1:
            taken.add(free[0])
            left[gap] = free[0]
            out.append((own["book"].iloc[0], row, free[0]))
    return pd.DataFrame(out, columns=["book", "row", "donor"])


def prefix_tier(rows: DataFrame, pairs: DataFrame, donors: DataFrame) -> DataFrame:
    """T5: open rows whose fold begins as the fold of exactly one free donor between the neighbours' donors does."""
    ends = donors.groupBy("book").agg((F.max("donor") + 1).alias("__stop"))
    d = rows.select("book", "row", F.col("prefix").alias("p")).join(pairs.select("book", "row", "donor"), ["book", "row"], "left")
    d = d.withColumn("anchor", F.when(F.col("donor").isNotNull(), F.col("row")))
    d = with_neighbours(d, "book", "row", {"lo": "donor", "gap": "anchor"}, {"hi": "donor"}).filter((F.col("donor").isNull()) & (F.length("p") == PREFIX)).drop("donor", "anchor")
    d = d.join(ends, "book").select("book", "row", "p", F.coalesce("lo", F.lit(-1)).alias("lo"), F.coalesce("hi", "__stop").alias("hi"), F.coalesce("gap", F.lit(-1)).alias("gap"), F.substring("p", 1, LEAST_FOLD).alias("head"))
    free = donors.join(pairs.select("book", "donor"), ["book", "donor"], "left_anti").select("book", "donor", F.col("prefix").alias("q")).filter(F.length("q") >= LEAST_FOLD)
    met = d.join(free.withColumn("head", F.substring("q", 1, LEAST_FOLD)), ["book", "head"]).filter("startswith(p, q) and donor > lo and donor < hi")
    return met.select("book", "row", "donor", "lo", "hi", "gap").groupBy("book").applyInPandas(choose_prefixes, PAIRS).withColumn("tier", F.lit("T5"))


def aligned(rows: DataFrame, donors: DataFrame, save=materialise) -> DataFrame:
    """(book, row, donor, tier) through all tiers; donor and tier are null where nothing matched. ``save(df, name)`` keeps a
    tier's pairs, so that a later tier does not work them out again: by default as a table in the shared folder."""
    texts, english = rows, donors
    row_keys = lambda ids: texts.join(ids.select("book", F.floor(F.col("id") / 2).alias("row")).distinct(), ["book", "row"], "left_semi").select("book", F.explode(F.array(*_row_keys())).alias("whole"))
    rows, donors = _shortened(rows, donors, save)
    equal = save(fold_tiers(rows, donors), "folds")
    open_rows, open_donors = rows.join(equal, ["book", "row"], "left_anti"), donors.join(equal, ["book", "donor"], "left_anti")
    held_donors = lambda held: open_donors.filter("not blank").join(held, ["book", "head"], "left_semi").select("book", "donor")
    donor_keys = lambda held: english.join(held_donors(held), ["book", "donor"], "left_semi").select("book", T.norm_key(F.col("english")).alias("whole"))
    content = save(equal.unionByName(translation_tier(open_rows, open_donors, row_keys, donor_keys)), "content")
    runs = steady_runs(content.select("book", "row", "donor")).select("book", "row")
    steady = save(content.join(runs, ["book", "row"], "left_semi"), "steady")
    placed = save(steady.unionByName(position_tier(rows, steady, donors)), "placed")
    done = placed.unionByName(prefix_tier(rows, placed, donors))
    return rows.select("book", "row").join(done, ["book", "row"], "left")


def tier_counts(tiers: DataFrame) -> DataFrame:
    """A row for each book: rows, rows of each tier, and rows without one. tiers: book, row, donor, tier."""
    return tiers.groupBy("book").agg(F.count("*").alias("n_rows"), *(F.count_if(F.col("tier") == t).alias(t.lower()) for t in ("T1", "T2", "T3", "T4", "T5")), F.count_if(F.col("tier").isNull()).alias("unmatched"))


def cross_checked(rows: DataFrame, numbers: DataFrame, least: int = 40) -> DataFrame:
    """(book, row, number) from a second donor. rows: book, row, narrator, text; numbers: book, text, number. Keys under
    ``least`` letters and keys with two numbers tell nothing; narrator and text together come before the text alone."""
    key = T.norm_key(F.col("text"))
    known = numbers.select("book", key.alias("key"), "number").filter(F.length("key") >= least).groupBy("book", "key").agg(F.min("number").alias("number"), F.max("number").alias("other")).filter("number = other").drop("other")
    text = F.coalesce("text", F.lit(""))
    keys = F.array(T.norm_key(F.concat(F.coalesce("narrator", F.lit("")), F.lit(" "), text)), T.norm_key(text))
    asked = rows.select("book", "row", F.posexplode(keys).alias("k", "key")).filter(F.length("key") >= least)
    return asked.join(known, ["book", "key"]).groupBy("book", "row").agg(F.min_by("number", "k").alias("number"))
