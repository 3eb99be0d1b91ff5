"""Record linkage: keys that prove equality, refusal of ambiguity, candidate windows, alignment of two sequences, trees."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..store import discard, fresh, materialise
from .ordered import running_count

#: Characters of a key that place it among others where that is enough, and that balance the ranges where it is not.
HEAD, WHOLE_LENGTH = 64, 4096
Keys = Callable[[DataFrame], DataFrame]


def repair_by_key(damaged: DataFrame, donors: DataFrame, group: str | None = None) -> DataFrame:
    """Damaged rows with the donor text that the bug would turn into them. damaged: id, body; donors: ord, body; both with
    group, if rows meet donors of their own group only. The first donor (by ord) with a candidate wins; two candidates with
    different keys are ambiguous and refused; among candidates with one key the least text is taken. status: repaired,
    unchanged, ambiguous, unmatched."""
    g = [group] if group else []
    keyed = damaged.select(*g, "id", T.digest(T.norm_key(F.col("body"))).alias("key"))
    return matched_by_key(keyed, donors, g).select("id", "status", "repaired")


def matched_by_key(keyed: DataFrame, donors: DataFrame, group: list[str]) -> DataFrame:
    """The rows of keyed (group, key, ...) with status and repaired as in ``repair_by_key``; key is the digest of a row's key.
    Only digests meet; the donors' texts are moved where repaired is read and are left out of the plan where it is not."""
    # never null, or the engine would work keys out once more to drop the null ones before the join
    named = lambda s: F.coalesce(T.digest(T.norm_key(s)), F.lit(""))
    c = donors.select(*group, "ord", F.col("body").alias("clean"), named(T.greedy_strip(F.col("body"))).alias("key"))
    clean_key = F.when(F.contains("clean", F.lit("[")), named(F.col("clean"))).otherwise(F.col("key"))  # else nothing was stripped
    c = c.withColumn("clean_key", clean_key)
    per = c.groupBy(*group, "key", "ord").agg(F.min("clean_key").alias("lo"), F.max("clean_key").alias("hi"), F.min("clean").alias("clean"))
    order = F.struct(F.col("ord").isNull(), "ord")  # a donor without a place comes last
    best = per.groupBy(*group, "key").agg(*(F.min_by(x, order).alias(x) for x in ("lo", "hi", "clean")))
    j = keyed.join(best, [*group, "key"], "left")
    status = F.when(F.col("lo").isNull(), "unmatched").when(F.col("lo") != F.col("hi"), "ambiguous").when(F.col("lo") == F.col("key"), "unchanged").otherwise("repaired")
    return j.withColumn("status", status).withColumn("repaired", F.when(F.col("status") == "repaired", F.col("clean"))).drop("lo", "hi", "clean")


def places(targets: DataFrame, donors: DataFrame) -> DataFrame:
    """(book, id, key, place): where bisect_left would insert each target into its book's sorted donor keys.
    targets: book, id, key; donors: book, key (distinct)."""
    both = targets.select("book", "key", F.lit(0).alias("is_donor"), "id").unionByName(donors.select("book", "key", F.lit(1).alias("is_donor"), F.lit(None).cast("long").alias("id")))
    return running_count(both, "book", "key", F.col("is_donor") == 1, "place", "is_donor").filter("is_donor = 0").select("book", "id", "key", "place")


def candidate_window(targets: DataFrame, donors: DataFrame, radius: int = 64) -> DataFrame:
    """(book, id, donor_rank): for each target the donors around its place in the sorted donor keys."""
    return places(targets, donors).select("book", "id", F.explode(F.sequence(F.greatest(F.col("place") - radius, F.lit(0)), F.col("place") + radius - 1)).alias("donor_rank"))


def fingerprint(key: Column) -> list[Column]:
    """What stands for a key in proofs: its digest (key) and the characters that place it among others (head)."""
    return [T.digest(key).alias("key"), F.substring(key, 1, HEAD).alias("head")]


def proved_in_window(targets: DataFrame, donors: DataFrame, target_keys: Keys, donor_keys: Keys, radius: int = 64) -> DataFrame:
    """(book, id, key, given): the donors, by the digest of their key, of each target's candidate window from which a bracket
    grouping gives the target. targets: book, id, key, head; donors: book, key (distinct), head, ways (``grouping_digests``
    of the text); both stored. Only digests meet. What two heads tell of the distance of two keys is enough for nearly all;
    where it is not, and only there, whole keys are made and ranked: target_keys gives (book, whole) for some (book, id),
    donor_keys for some (book, head); more than these is no harm."""
    ways = donors.select("book", F.explode("ways").alias("key"), F.col("key").alias("given"), F.col("head").alias("given_head"))
    met = materialise(targets.select("book", "id", "key", "head").join(ways, ["book", "key"]), "met")
    asked = met.select("book", "head").unionByName(met.select("book", F.col("given_head").alias("head"))).distinct()
    sizes = donors.groupBy("book", "head").agg(F.count("*").alias("n")).unionByName(asked.withColumn("n", F.lit(0).cast("long")))
    heads = running_count(sizes.groupBy("book", "head").agg(F.sum("n").alias("n")), "book", "head", F.col("n"), "upto")
    heads = materialise(heads.select("book", "head", (F.col("upto") - F.col("n")).alias("start"), "n"), "heads")
    of = lambda head, x: heads.select("book", F.col("head").alias(head), F.col("start").alias(f"{x}_least"), (F.col("start") + F.col("n")).alias(f"{x}_stop"))
    placed = met.join(of("head", "t"), ["book", "head"]).join(of("given_head", "d"), ["book", "given_head"])
    # a target's place lies in [t_least, t_stop], a donor's rank in [d_least, d_stop - 1]
    sure = (F.col("d_least") >= F.col("t_stop") - radius) & (F.col("d_stop") <= F.col("t_least") + radius)
    never = (F.col("d_stop") <= F.col("t_least") - radius) | (F.col("d_least") >= F.col("t_stop") + radius)
    near, undecided = placed.filter(sure).select("book", "id", "key", "given"), placed.filter(~sure & ~never)
    if undecided.isEmpty():
        return near
    held = undecided.select("book", "head").unionByName(undecided.select("book", F.col("given_head").alias("head"))).distinct()
    named = lambda df: df.select("book", "whole", *fingerprint(F.col("whole")))
    d = named(donor_keys(held)).join(held, ["book", "head"], "left_semi").groupBy("book", "head", "key").agg(F.first("whole").alias("whole"))
    t = named(target_keys(undecided.select("book", "id").distinct())).join(undecided.select("book", "key").distinct(), ["book", "key"], "left_semi").groupBy("book", "head", "key").agg(F.first("whole").alias("whole"))
    both = materialise(d.withColumn("is_donor", F.lit(1)).unionByName(t.withColumn("is_donor", F.lit(0))).select(F.struct("book", "head").alias("group"), "key", "whole", "is_donor"), "whole-keys")
    inside = running_count(both, "group", "whole", F.col("is_donor"), "r", "is_donor", WHOLE_LENGTH).select(F.col("group.book").alias("book"), "key", "is_donor", "r")
    inside = materialise(inside, "ranks")
    place = inside.filter("is_donor = 0").select("book", "key", F.col("r").alias("t_r"))
    rank = inside.filter("is_donor = 1").select("book", F.col("key").alias("given"), (F.col("r") - 1).alias("d_r"))
    apart = F.col("d_least") + F.col("d_r") - F.col("t_least") - F.col("t_r")
    return near.unionByName(undecided.join(place, ["book", "key"]).join(rank, ["book", "given"]).filter((apart >= -radius) & (apart < radius)).select("book", "id", "key", "given"))


def proofs(targets: DataFrame, donors: DataFrame, radius: int = 64) -> tuple[DataFrame, DataFrame]:
    """(book, id, lo, hi), the least and the greatest key of the donors that prove each target, where any does, and the stored
    donors (book, key, clean), the least text of each key; keys are digests. A donor whose key is the target's lost nothing
    and does not count. targets: book, id, key (whole); donors: book, clean."""
    d = donors.select("book", "clean", *fingerprint(T.norm_key(F.col("clean")))).groupBy("book", "key").agg(F.first("head").alias("head"), F.min("clean").alias("clean"))
    d = materialise(d.withColumn("ways", T.grouping_digests(F.col("clean"))), "donors")
    t = materialise(targets.select("book", "id", *fingerprint(F.col("key"))), "targets")
    target_keys = lambda ids: targets.join(ids, ["book", "id"], "left_semi").select("book", F.col("key").alias("whole"))
    donor_keys = lambda held: d.join(held, ["book", "head"], "left_semi").select("book", T.norm_key(F.col("clean")).alias("whole"))
    near = proved_in_window(t, d, target_keys, donor_keys, radius)
    return near.filter("given <> key").groupBy("book", "id").agg(F.min("given").alias("lo"), F.max("given").alias("hi")), d.select("book", "key", "clean")


def proof_status(targets: DataFrame, donors: DataFrame, radius: int = 64) -> DataFrame:
    """(book, id, status, clean) for every target: repaired if the donors near it from which a bracket grouping gives it have
    one key, ambiguous if they have several, unmatched if there is none. Among donors of one key the least text is taken.
    targets: book, id, key; donors: book, clean."""
    per, d = proofs(targets, donors, radius)
    per = per.join(d.withColumnRenamed("key", "lo"), ["book", "lo"], "left").withColumnsRenamed({"book": "__book", "id": "__id", "clean": "__clean"})
    j = targets.select("book", "id").distinct().join(per, F.col("book").eqNullSafe(F.col("__book")) & F.col("id").eqNullSafe(F.col("__id")), "left")
    status = F.when(F.col("lo").isNull(), "unmatched").when(F.col("lo") != F.col("hi"), "ambiguous").otherwise("repaired")
    return j.select("book", "id", status.alias("status"), F.when(status == "repaired", F.col("__clean")).alias("clean"))


def repair_by_proof(targets: DataFrame, donors: DataFrame, radius: int = 64) -> DataFrame:
    """(book, id, clean): the targets that one donor key proves; those that several prove are refused (see ``proof_status``)."""
    per, d = proofs(targets, donors, radius)
    return per.filter("lo = hi").select("book", "id", F.col("lo").alias("key")).join(d, ["book", "key"]).select("book", "id", "clean")


def agreed(matches: DataFrame) -> DataFrame:
    """Rows whose matches in several donors agree in content. matches: id, clean."""
    g = matches.withColumn("key", T.norm_key(F.col("clean"))).groupBy("id").agg(F.countDistinct("key").alias("keys"), F.count("*").alias("confirmed_by"), F.min("clean").alias("clean"))
    return g.filter("keys = 1").select("id", "clean", "confirmed_by")


def attach_unique(rows: DataFrame, facts: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """rows with the facts of their key as a sorted array<struct<name, value>>; a key whose name has two values is refused
    (null). rows and facts: key and, in facts, name and value. Facts are summed up before the join."""
    per = facts.groupBy(key, name).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    per = per.groupBy(key).agg(F.max(F.col("lo") != F.col("hi")).alias("refused"), F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), F.col("lo").alias("value")))).alias("facts"))
    return rows.join(per, key, "left").withColumn("facts", F.when(~F.col("refused"), F.col("facts"))).withColumn("refused", F.coalesce("refused", F.lit(False)))


def _grades_of(keyed: DataFrame, entries: DataFrame, target_keys: Keys, donor_keys: Keys, radius: int) -> DataFrame:
    """(book, id, grades) of the rows whose key has grades: those of the key, or else of the one donor that proves it.
    keyed: book, id, key, head; entries: book, ord, key, head, blank, ways, grades; the others as for ``proved_in_window``."""
    # a key's copies are summed up by their distinct gradings, which are few, never gathered one by one
    flat = F.array_sort(F.flatten(F.collect_set("grades")))
    exact = entries.groupBy("book", "key").agg(F.array_distinct(flat).alias("grades"))
    names = F.array_distinct(F.transform("grades", lambda g: g["name"]))
    exact = exact.withColumn("grades", F.when(F.size("grades") == F.size(names), F.col("grades")))  # a grader with two verdicts is refused
    found = keyed.join(exact, ["book", "key"]).select("book", "id", "grades")
    first = entries.filter("not blank").groupBy("book", "key", "head").agg(F.min_by(F.struct("ways", "grades"), "ord").alias("e"))
    first = materialise(first.select("book", "key", "head", "e.ways", "e.grades"), "first-entries")
    damaged = materialise(keyed.join(exact.select("book", "key"), ["book", "key"], "left_anti"), "damaged")
    proved = proved_in_window(damaged, first, target_keys, donor_keys, radius).groupBy("book", "id").agg(F.min("given").alias("key"), F.max("given").alias("other"))
    twin = proved.filter("key = other").join(first.select("book", "key", "grades"), ["book", "key"])
    return found.unionByName(twin.select("book", "id", "grades")).filter("size(grades) > 0")


def lookup_grades(rows: DataFrame, entries: DataFrame, radius: int = 64) -> DataFrame:
    """rows (book, id, narrator, text) with grades, or null: by the key of narrator and text, or else by that of the text. A key
    has the grades of all entries of that key, refused if a grader has two verdicts; a key without an entry has those of the
    first entry of its clean twin, the one donor key that proves it. entries: book, ord, text, grades (array<struct<name, grade>>)."""
    own = rows.filter("trim(text) <> ''").select("book", "id", F.coalesce("narrator", F.lit("")).alias("narrator"), F.trim("text").alias("text"))
    keys = [T.norm_key(F.concat_ws(" ", "narrator", "text")), T.norm_key(F.col("text"))]
    # texts are read once, and fingerprints stand for them from there on
    asked = materialise(own.select("book", "id", *(F.struct(*fingerprint(k)).alias(f"k{i}") for i, k in enumerate(keys))), "grade-targets")
    text = F.coalesce("text", F.lit(""))
    e = entries.select("book", "ord", *fingerprint(T.norm_key(text)), (F.trim(text) == "").alias("blank"), T.grouping_digests(text).alias("ways"), "grades")
    e = materialise(e, "grade-entries")
    asked_keys = lambda i: lambda ids: own.join(ids, ["book", "id"], "left_semi").select("book", keys[i].alias("whole"))
    heads = e.filter("not blank").select("book", "ord", "head")
    given = lambda held: entries.join(heads.join(held, ["book", "head"], "left_semi").select("book", "ord").distinct(), ["book", "ord"], "left_semi").filter("trim(text) <> ''").select("book", T.norm_key(F.col("text")).alias("whole"))
    of = lambda df, i: _grades_of(df.select("book", "id", f"k{i}.key", f"k{i}.head"), e, asked_keys(i), given, radius)
    whole = materialise(of(asked, 0), "whole-grades")
    text_only = of(asked.join(whole.select("book", "id"), ["book", "id"], "left_anti"), 1)
    return rows.drop("grades").join(whole.unionByName(text_only), ["book", "id"], "left")


def align_groups(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (book, row, donor) of equal folds whose groups are equally large, in order. left: book, row, fold; right: the same.
    A fold that occurs once on each side is the common case of a group of one."""

    def numbered(df: DataFrame, place: str) -> DataFrame:
        w = Window.partitionBy("book", "fold")
        return df.select("book", "fold", F.col("row").alias(place), F.row_number().over(w.orderBy("row")).alias("i"), F.count("*").over(w).alias("n"))

    return numbered(left, "row").join(numbered(right, "donor"), ["book", "fold", "i", "n"]).select("book", "row", "donor", "n")


def descendants(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(ancestor, node, depth) for edges (node, parent), each node its own ancestor at depth 0, to any depth. Each level is
    stored once and the next one starts from it. A cycle raises ValueError."""
    edges = edges.select("node", "parent")
    levels = [edges.select(F.col("node").alias("ancestor"), "node", F.lit(0).alias("depth"))]
    while True:
        level = levels[-1].alias("l").join(edges.alias("e"), F.col("l.node") == F.col("e.parent")).select("l.ancestor", "e.node", (F.col("l.depth") + 1).alias("depth"))
        level = materialise(level, "tree-level")
        found = level.agg(F.count("*").alias("n"), F.min(F.when(F.col("ancestor") == F.col("node"), F.col("node"))).alias("loop")).first()
        if found["loop"] is not None:
            raise ValueError(f"the tree has a cycle through {found['loop']!r}")
        if not found["n"]:
            discard(level)
            return reduce(DataFrame.unionByName, levels)
        levels.append(level)


def tree_stats(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(root, depth, nodes): how many nodes lie at each depth below each root, a node without a parent."""
    roots = edges.filter("parent is null").select(F.col("node").alias("root"))
    return descendants(spark, edges).join(roots, F.col("ancestor") == F.col("root"), "left_semi").groupBy(F.col("ancestor").alias("root"), "depth").agg(F.count("*").alias("nodes"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with side."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each key that one side lacks or whose columns differ: a gate passes if there is none."""
    own = [c for c in left.columns if c not in keys]
    l, r = left.select(*keys, F.struct(*own).alias("l")), right.select(*keys, F.struct(*own).alias("r"))
    return l.join(r, keys, "full_outer").filter(~F.col("l").eqNullSafe(F.col("r")))


def refuse(problems: DataFrame, what: str, shown: int = 20) -> None:
    """Raises ValueError with the first rows of problems, if it has any: what a gate or an all-or-nothing build ends with."""
    rows = problems.limit(shown).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def key_groups(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """(key, n, first) of the keys that several rows share: the MD5 of the key, its rows, and their smallest id. Only hashes
    are shuffled, and they are counted before."""
    return df.groupBy(F.md5(key.cast("binary")).alias("key")).agg(F.count("*").alias("n"), F.min(id_col).alias("first")).filter("n > 1")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, copies) of the keys that several rows share; nulls are equal. Rows are grouped by two hashes of the keys, of 128
    and 64 bits, which are all that is shuffled for keys that occur once."""
    row = F.to_json(F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))), {"ignoreNullFields": "false"})
    a, b = fresh(df.columns, "key_md5"), fresh(df.columns, "key_hash")
    hashed = df.select(F.md5(row.cast("binary")).alias(a), F.xxhash64(row).alias(b), *keys)
    often = hashed.groupBy(a, b).agg(F.count("*").alias("copies")).filter("copies > 1")
    named = hashed.join(often, [a, b]).groupBy(a, b).agg(*(F.first(k).alias(k) for k in keys), F.first("copies").alias("copies"))
    return named.select(*keys, "copies")


def manifest(df: DataFrame, group: str, text: str) -> DataFrame:
    """A row for each group: docs, bytes and a digest of its texts that no order changes: the sums of the first four 32-bit
    words of their SHA-256. Sums are partial, so a group is never gathered."""
    d = df.select(group, text, F.sha2(text, 256).alias("digest_hex")) if text != group else df.withColumn("digest_hex", F.sha2(text, 256))
    words = [F.sum(F.conv(F.substring("digest_hex", 1 + 8 * i, 8), 16, 10).cast("long")).cast("string") for i in range(4)]
    return d.groupBy(group).agg(F.count("*").alias("docs"), F.sum(F.octet_length(text).cast("long")).alias("bytes"), F.concat_ws("-", *words).alias("digest"))
