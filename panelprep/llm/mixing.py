"""Mixing sources to target weights by pivotal dependent rounding.

A source with target T and size S gives each of its documents T/S copies in
expectation: the whole part surely, the fraction by dependent rounding.  Pivotal
rounding takes two fractions and moves mass from one to the other at random,
keeping each one's expectation, until one of them is 0 or 1; the other goes on.
So the number of rounded-up documents is the sum of the fractions up to one.
Documents of like size are paired, so the words come out near the target, too.

The work is a reduction tree of DataFrame steps: groups of some dozens of
documents of one source and like size are rounded inside an array, each leaves
one document with a fraction over, and the remainders are grouped again until
there is one for each source, whose fraction then decides by a draw.

A source's documents are rounded in three bands, the longest first.  What a band
took too little or too much is made up by the next ones: their rate is what is
still owed over the words they have.  So a source misses its target by about a
document of the last band, which has the shortest ones.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelprep.llm.common import count_words, spread, stored

GROUP = 48  # documents in a group on average
BANDS = (1.0, 0.4, 0.08)  # share of a source's words that a band and those after it have at most


def source_targets(sizes: DataFrame, most: float = 3.0) -> DataFrame:
    """Targets from ``(source, source_size)``, one row a source: ``source, source_size, target``.

    Sources by code point, null last, weigh 1, 2, 3, 1, … and share the total; a
    target over ``most`` times its source's size stops there and the excess is
    shared by weight again.  With the sources in the order in which they reach
    their stop, the level ``target / weight`` of those that don't is the first
    one not above the next stop.  The windows are over one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", (F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).cast("double")).withColumn(
        "stop", F.lit(most) * F.col("source_size"))
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level)
    reached = F.when(F.col("level") <= F.col("stop") / F.col("weight"), F.col("level"))
    levels = levels.withColumn("level", F.first(reached, ignorenulls=True).over(
        by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return levels.select("source", "source_size", F.least(
        F.col("stop"), F.coalesce(F.col("level") * F.col("weight"), F.col("stop"))).alias("target"))


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a 64-bit digest of the parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(2**53)


def _pivot(units: Column, seed: int) -> Column:
    """Rounds an ordered array of units: ``done`` has those decided, ``rest`` the one left over, with its mass.

    Of masses a and b below 1: if a+b < 1, one takes it all (a with probability
    a/(a+b)) and the other falls to 0; else one rises to 1 and the other keeps
    a+b-1 (a keeps it with probability (1-a)/(2-a-b)).
    """
    start = F.struct(F.transform(F.slice(units, 1, 0), lambda x: F.struct(x["doc"].alias("doc"), F.lit(0).alias("up"))).alias("done"),
                     F.element_at(units, 1).alias("rest"))

    def step(state: Column, unit: Column) -> Column:
        rest = state["rest"]
        total = rest["mass"] + unit["mass"]
        low = total < 1
        u = _uniform(F.lit(seed), rest["k"], unit["k"])
        stays = F.when(low, u * total < rest["mass"]).otherwise(u * (2 - total) < 1 - rest["mass"])
        kept = F.when(stays, rest).otherwise(unit)
        return F.struct(
            F.concat(state["done"], F.array(F.struct(
                F.when(stays, unit["doc"]).otherwise(rest["doc"]).alias("doc"), F.when(low, 0).otherwise(1).alias("up")))).alias("done"),
            F.struct(kept["size"].alias("size"), kept["k"].alias("k"),
                     F.when(low, total).otherwise(total - 1).alias("mass"), kept["doc"].alias("doc")).alias("rest"))

    return F.aggregate(F.slice(units, F.lit(2), F.greatest(F.size(units) - 1, F.lit(0))), start, step)


def document_key(id_col: str, source_col: str, text_col: str) -> Column:
    """Identity of a document: a digest of id, source, and the text's size and crc."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return F.md5(F.to_json(F.struct(
        F.col(id_col).cast("string").alias("i"), F.col(source_col).cast("string").alias("s"),
        F.octet_length(text).alias("b"), F.crc32(text).alias("c"))).cast("binary"))


def mix_plan(docs: DataFrame, seed: int = 7, most: float = 3.0, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text") -> DataFrame:
    """A row per different document: ``k, id, source, size, n, source_size, target, copies``.

    ``n`` is how many equal rows it has and ``copies`` how often the mix takes it
    in all, at most ``most * n`` times.  A null source is a source of its own, a
    null text has size 0, and a source without words has target 0 and no copies.
    Equal rows (id, source, size and crc) are one document of n times the mass, so
    a group of them is counted before the shuffle.  An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), count_words(F.col(text_col)).alias("size"),
        document_key(id_col, source_col, text_col).alias("k"))
    units = stored(rows.groupBy("k").agg(
        F.first("id").alias("id"), F.first("source").alias("source"), F.first("size").alias("size"), F.count(F.lit(1)).alias("n"),
    ).withColumn("class", F.floor(F.log2(F.col("size") + 1.0) * 4).cast("int")), "units")

    by_size = Window.partitionBy("source").orderBy("class")  # some dozens of classes a source
    upto = F.try_divide(F.sum("words").over(by_size), F.sum("words").over(Window.partitionBy("source")))
    band = sum((F.coalesce(upto <= share, F.lit(True)).cast("int") for share in BANDS[1:]), F.lit(0))
    per_class = units.groupBy("source", "class").agg(
        F.sum(F.col("size") * F.col("n")).alias("words"), F.count(F.lit(1)).alias("docs")).withColumn("band", band)
    sizes = stored(per_class.groupBy("source").agg(
        F.sum("words").alias("source_size"), F.map_from_entries(F.collect_list(F.struct("class", F.struct("docs", "band")))).alias("classes"),
        F.array(*(F.sum(F.when(F.col("band") >= b, F.col("words")).otherwise(0)) for b in range(len(BANDS)))).alias("from_band")), "sizes")
    targets = source_targets(sizes.select("source", "source_size"), most)
    sources = stored(targets.alias("t").join(sizes.alias("s"), F.expr("t.source <=> s.source")).select(
        "t.source", "t.source_size", "t.target", "s.classes", "s.from_band"), "sources")
    owed, plans = sources.withColumn("owed", F.col("target")), []
    for number in range(len(BANDS)):
        rate = F.coalesce(F.try_divide(F.greatest("owed", F.lit(0.0)), F.element_at("from_band", number + 1)), F.lit(0.0))
        rates = stored(owed.withColumn("rate", F.least(rate, F.lit(float(most)))), f"rates{number}")
        plans.append(stored(_rounded(units, rates, number, seed), f"plan{number}"))
        taken = plans[-1].groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        owed = rates.drop("rate").alias("r").join(taken.alias("k"), F.expr("r.source <=> k.source"), "left").select(
            *(f"r.{c}" for c in sources.columns), (F.col("owed") - F.coalesce("taken", F.lit(0))).alias("owed"))
    return reduce(DataFrame.unionByName, plans)


def _rounded(units: DataFrame, rates: DataFrame, band: int, seed: int) -> DataFrame:
    """The documents of one band with their ``copies``, by the rate of their source."""
    share = F.col("n") * F.col("rate")
    whole = F.floor(share + 1e-9)
    doc = F.struct("k", "id", F.col("u.source").alias("source"), "size", "n", "r.source_size", "target", whole.cast("long").alias("whole"))
    mass = F.greatest(share - whole, F.lit(0.0))
    known = F.element_at("classes", F.col("class"))
    state = stored(units.alias("u").join(rates.alias("r"), F.expr("u.source <=> r.source")).where(known["band"] == band).select(
        doc.alias("doc"), "class", mass.alias("mass"), F.ceil(known["docs"] / F.lit(float(GROUP))).alias("groups")), "shares")

    decided = [state.where("mass < 1e-9").select("doc", F.lit(0).alias("up"))]
    rest = state.where("mass >= 1e-9").select(
        "doc", "class", "groups", F.struct(F.col("doc.size").alias("size"), F.col("doc.k").alias("k"), "mass", "doc").alias("unit"))
    groups = state.agg(F.max("groups")).first()[0] or 1
    for level in itertools.count():
        last = groups == 0  # every class has one remainder: join the classes of a source
        part = F.lit(0).cast("long") if last else F.pmod(F.xxhash64(F.lit(level), F.lit(seed), F.col("doc.k")), F.col("groups"))
        grouped = rest.groupBy(
            F.col("doc.source").alias("source"), (F.lit(-1) if last else F.col("class")).alias("class"), part.alias("part"),
        ).agg(F.array_sort(F.collect_list("unit")).alias("units"), F.max("groups").alias("groups"))
        tree = stored(grouped.select("class", F.ceil(F.col("groups") / F.lit(float(GROUP))).alias("groups"),
                                     _pivot(F.col("units"), seed + level).alias("out")), f"level{level}")
        decided.append(tree.select(F.explode("out.done").alias("x")).select("x.doc", "x.up"))
        rest = tree.select("out.rest.doc", "class", "groups", F.col("out.rest").alias("unit"))
        if last:
            break
        groups = 0 if groups == 1 else -(-groups // GROUP)
    decided.append(rest.select("doc", (_uniform(F.lit(seed), F.lit("last"), F.col("unit.k")) < F.col("unit.mass")).cast("int").alias("up")))
    plan = reduce(DataFrame.unionByName, decided)
    return plan.select("doc.*", "up").withColumn("copies", F.col("whole") + F.col("up")).drop("whole", "up")


def mixed_rows(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row per input row: id, ``size, source, source_size, target, copies, taken``; equal rows share their document's copies."""
    each = spread(plan, "n", "j")
    copies = F.floor(F.col("copies") / F.col("n")) + (F.col("j") < F.pmod("copies", "n")).cast("long")
    return each.select(F.col("id").alias(id_col), "size", "source", "source_size", "target",
                       copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """The mix itself: each document as often as ``plan`` takes it, with all columns of ``docs``."""
    keyed = docs.select(document_key(id_col, source_col, text_col).alias("_k"), F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    taken = plan.where("copies > 0").select(F.col("k").alias("_k"), F.col("copies").alias("_copies"))
    matched = keyed.dropDuplicates(["_k"]).join(taken, "_k")  # equal rows meet as one: each task reduces its own first
    once = matched.where("_copies <= 4096").select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    often = spread(matched.where("_copies > 4096"), "_copies", "_j")
    return once.select("_doc.*").unionByName(often.select("_doc.*"))
