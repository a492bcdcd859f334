"""Audit of how document filters interact, over every order of applying them.

Each filter is a condition under which a document fails.  The conditions of a
text alone are column expressions.  The filter of exact copies is an
existential self-join: a document fails if some document with the same hash
and the same text has a smaller doc_id, a left-semi join of the texts whose
hash occurs more than once.  Its right side is reduced to the least doc_id of
each text first, so a group of copies is one row there, and it is written to
the shared folder, so that the join reads both sides from plain exchanges and
Spark can split a hot text's rows on the left.

The ids so marked are united with those that fail the other filters; per id the
failure bits are or-ed, and per part only counts of bit combinations remain (at
most 2^filters rows), from which every order's steps are worked out.

Defined cases: a null text is empty; a null part is the empty string; a null
doc_id is never smaller than another, nor has it a smaller one, and has no
label; rows that are alike in doc_id, part and text are documents of their own
with one set of bits; a doc_id labelled more than once counts as labelled 1 if
any label says so; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import cut

SPACE = r"[\x20\x09-\x0D]+"


def default_filters() -> dict[str, Column | None]:
    """Failure conditions over ``text`` and ``words``; None stands for the join on smaller copies."""
    words = F.size("words")
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": words < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * words,
        "C": 100 * capitals > 3 * F.length("text"),
        "D": F.col("text").rlike(r"[#$%&*|]"),
        "E": None,
    }


def smaller_copies(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, h, text, ...) that have an equal text under a smaller doc_id.

    Hashes are counted first, without texts, so that only texts whose hash
    occurs again are compared; every text is shuffled once at most.
    """
    shared = cut(rows.groupBy(F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_h"))
    again = cut(rows.join(shared, F.col("h") == F.col("_h"), "left_semi"))
    least = cut(again.where(F.col("doc_id").isNotNull()).groupBy(F.col("h").alias("_h"), F.col("text").alias("_text"))
                .agg(F.min("doc_id").alias("_least")))
    return again.join(least, (F.col("h") == F.col("_h")) & (F.col("text") == F.col("_text")) & (F.col("_least") < F.col("doc_id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column | None], part: str) -> DataFrame:
    """part, bits (filter k sets bit k), documents n, and how many of them are labelled good and toxic."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    key = ["doc_id", "part", "h"]
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    own = F.lit(0)
    for k, condition in enumerate(filters.values()):
        if condition is not None:
            own = own + F.when(condition, F.lit(1 << k)).otherwise(0)
    failures = hashed.withColumn("words", words).select(*key, own.cast("long").alias("bits"), F.lit(1).cast("long").alias("n"))
    for k, condition in enumerate(filters.values()):
        if condition is None:
            failures = failures.unionByName(smaller_copies(hashed).select(*key, F.lit(1 << k).cast("long").alias("bits"), F.lit(0).cast("long").alias("n")))
    per_id = failures.groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    # per id and combination first: rows of one id are few then, and the join moves numbers only
    few = per_id.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    joined = few.join(marks, F.col("doc_id") == F.col("_id"), "left")
    return joined.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column | None] | None = None, part: str = "lang") -> DataFrame:
    """For every part, order of the filters and step: what the step's filter keeps, removes, repeats and costs.

    kept: documents left after the step; removed: gone at it; redundant: failing
    its filter but removed before; unique_fails: failing no other filter;
    good_lost, toxic_lost: removed with that label; shapley: the filter's
    removals added up over all orders, at whatever step it stood.
    """
    filters = filters or default_filters()
    names = "".join(filters)
    bit = {name: 1 << k for k, name in enumerate(names)}
    orders = list(permutations(names))
    counts = (combinations(docs, labels, filters, part).groupBy("part")
              .agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("c")))   # at most 2^filters entries

    steps = F.array(*[F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step + 1).alias("step"), F.lit(bit[name]).cast("long").alias("own"),
                               F.lit(sum(bit[x] for x in order[:step])).cast("long").alias("before"))
                      for order in orders for step, name in enumerate(order)])

    def total(what: str, where) -> Column:
        return F.aggregate("c", F.lit(0).cast("long"), lambda s, x: s + F.when(where(x["bits"]), x[what]).otherwise(0))

    own, before = F.col("own"), F.col("before")

    def removed(bits):
        return (bits.bitwiseAND(before) == 0) & (bits.bitwiseAND(own) != 0)

    #: how many orders put each set of other filters before a filter
    ways = {}
    for order in orders:
        for step, name in enumerate(order):
            set_before = (bit[name], sum(bit[x] for x in order[:step]))
            ways[set_before] = ways.get(set_before, 0) + 1
    def removals(own_bit: int, earlier: int) -> Column:
        return F.aggregate("c", F.lit(0).cast("long"), lambda s, x: s + F.when(
            (x["bits"].bitwiseAND(F.lit(earlier)) == 0) & (x["bits"].bitwiseAND(F.lit(own_bit)) != 0), x["n"]).otherwise(0))

    shapley = F.lit(None).cast("long")
    for name in names:
        mine = sum((many * removals(*k) for k, many in ways.items() if k[0] == bit[name]), F.lit(0).cast("long"))
        shapley = F.when(own == bit[name], F.col(f"shapley_{name}")).otherwise(shapley)
        counts = counts.withColumn(f"shapley_{name}", mine)
    return (counts.select("part", "c", *[f"shapley_{x}" for x in names], F.inline(steps))
            .select("part", "filter_order", "step",
                    total("n", lambda b: b.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
                    total("n", removed).alias("removed"),
                    total("n", lambda b: (b.bitwiseAND(before) != 0) & (b.bitwiseAND(own) != 0)).alias("redundant"),
                    total("n", lambda b: b == own).alias("unique_fails"),
                    total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
                    shapley.alias("shapley")))
