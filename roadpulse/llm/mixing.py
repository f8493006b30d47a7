"""Operator 3: mixing sources to target weights by pivotal dependent rounding, in DataFrame functions.

Each source gets a target number of words; each document of it should be taken
``target / source size`` times, a whole number of copies plus a fraction. Independent rounding
would scatter a source's total; dependent rounding does not: two fractional documents exchange
words, as much as makes one of them whole, in a random direction whose odds keep every
document's expected copies. The exchange is in words, so the source's total stays as it was,
and only the last fraction left in a source is rounded for itself, to the nearer number.

A distributed tree does the pairing. The leaves are buckets of some hundred documents of a
source, folded one document after the other into at most one fractional residual; residuals are
bucketed and folded again until a source has one left. A leaf holds a bounded number of rows
whatever a source's size, so a hot source is as many tasks as its size asks for. Long documents are folded
first: the many short ones after them make them whole, and what is left in the end is short.

All randomness is a hash of the documents' ids, sizes and the seed: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.llm.common import WORD, named, saved, table

#: Documents that a leaf folds on average, and residuals that an inner node folds.
FAN_IN = 256

# Fixed values of the registered mix: weights by rank, repeating, the share of all words, the
# most copies of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2


def words_in(text: Column) -> Column:
    """How many words a text has; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sized: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_copies: float = MOST_COPIES,
) -> DataFrame:
    """source, source_size, target of the sources of ``sized`` (source, size), null one included.

    Sources take the weights in code point order, the null source last. Targets share ``share``
    of all words by weight, up to ``most_copies`` times the source's size; what is above is
    shared again among the others until none is above. That end is reached at one level: sources
    whose cap per weight is below it are at their cap, the others at level times weight. Sorted
    by cap per weight, it is the first level that does not reach the next cap; those after it are
    lower, for they give more than its share to a source. One row per source is sorted in one
    task; documents are not.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int")
    )
    ranked = sizes.withColumn("weight", weight).withColumn(
        "cap", F.lit(float(most_copies)) * F.col("source_size")
    )
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, W.unboundedFollowing)
    everything = by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.least(
        F.lit(float(share)) * F.sum("source_size").over(everything), F.sum("cap").over(everything)
    )
    spent = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = (total - spent) / F.sum("weight").over(onward)
    leveled = ranked.withColumn("level", level)
    final = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(
        everything
    )
    target = F.least("cap", F.coalesce(final * F.col("weight"), F.col("cap")))
    return leveled.withColumn("target", target).select("source", "source_size", "target")


def _fold(items: Column, seed: int) -> Column:
    """Fold (key, words, part) items into whole ones and at most one with a fraction.

    Result: struct of ``done`` (array of key, whole) and ``left`` (an item or null).
    """
    empty = F.array().cast("array<struct<key:bigint,whole:int>>")
    start = F.struct(empty.alias("done"), F.lit(None).cast("struct<key:bigint,words:double,part:double>").alias("left"))

    def settled(key: Column, whole: int) -> Column:
        return F.array(F.struct(key.alias("key"), F.lit(whole).alias("whole")))

    def item(key: Column, words: Column, part: Column) -> Column:
        return F.struct(key.alias("key"), words.alias("words"), part.alias("part"))

    def step(so_far: Column, new: Column) -> Column:
        old = so_far["left"]
        # Words that may move from new to old, or from old to new, until one of them is whole.
        up = F.least((1 - old["part"]) * old["words"], new["part"] * new["words"])
        down = F.least(old["part"] * old["words"], (1 - new["part"]) * new["words"])
        draw = F.pmod(F.xxhash64(F.lit(seed), old["key"], new["key"]), F.lit(1 << 40)) / float(1 << 40)
        rises = draw * (up + down) < down
        old_full = rises & ((1 - old["part"]) * old["words"] <= new["part"] * new["words"])
        new_empty = rises & ~old_full
        old_empty = ~rises & (old["part"] * old["words"] <= (1 - new["part"]) * new["words"])
        # What remains in the other one, kept strictly inside (0, 1) unless it is whole too.
        moved = F.when(rises, up).otherwise(-down)
        old_part = old["part"] + moved / old["words"]
        new_part = new["part"] - moved / new["words"]
        first = F.when(old_full, settled(old["key"], 1)).when(
            old_empty, settled(old["key"], 0)
        ).when(new_empty, settled(new["key"], 0)).otherwise(settled(new["key"], 1))
        rest_is_new = old_full | old_empty
        rest = F.when(rest_is_new, item(new["key"], new["words"], new_part)).otherwise(
            item(old["key"], old["words"], old_part)
        )
        whole = F.when(rest["part"] <= 1e-12, 0).when(rest["part"] >= 1 - 1e-12, 1)
        last = F.when(whole == 0, settled(rest["key"], 0)).when(whole == 1, settled(rest["key"], 1))
        return F.when(
            old.isNull(),
            F.struct(
                so_far["done"].alias("done"), item(new["key"], new["words"], new["part"]).alias("left")
            ),
        ).otherwise(
            F.struct(
                F.concat(so_far["done"], first, F.coalesce(last, empty)).alias("done"),
                F.when(last.isNull(), rest).alias("left"),
            )
        )

    return F.aggregate(items, start, step)


def copies(sized: DataFrame, targets: DataFrame, seed: int = 7, fan_in: int = FAN_IN) -> DataFrame:
    """(source, key, size, rows, copies): how often each group of equal rows is taken in all.

    ``sized`` has (source, key, size); rows equal in these three are one group, whose expected
    copies are rounded together. ``key`` must be a long.
    """
    groups = sized.groupBy("source", "key", "size").agg(F.count("*").alias("rows"))
    wanted = groups.join(targets, groups["source"].eqNullSafe(targets["source"])).drop(
        targets["source"]
    )
    expected = F.when(
        F.col("source_size") > 0,
        F.col("rows") * F.col("target") / F.col("source_size"),
    ).otherwise(F.lit(0.0))
    wanted = wanted.withColumn("expected", expected).withColumn(
        "base", F.floor(F.col("expected") + 1e-12)
    )
    # A group's id within its source; two groups of one key differ in size.
    wanted = wanted.withColumn("item", F.xxhash64("key", "size", F.lit(seed)))
    wanted = saved(wanted.drop("source_size", "target"), "mixing-wanted")
    part = F.col("expected") - F.col("base")
    open_items = wanted.where((part > 1e-12) & (F.col("size") > 0)).select(
        "source",
        F.col("item").alias("key"),
        F.col("size").cast("double").alias("words"),
        part.alias("part"),
    )
    counts = open_items.groupBy("source").agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    decided = None
    while most > 0:
        buckets = counts.withColumn("buckets", F.ceil(F.col("n") / fan_in))
        placed = open_items.join(
            buckets.drop("n"), open_items["source"].eqNullSafe(buckets["source"])
        ).drop(buckets["source"])
        # The level is part of the hash: items that met once are dealt anew.
        bucket = F.pmod(F.xxhash64("key", F.lit(seed), F.lit(most)), F.col("buckets"))
        folded = (
            placed.withColumn("bucket", bucket)
            .groupBy("source", "bucket")
            .agg(F.collect_list(F.struct("words", "key", "part")).alias("items"))
            .select("source", _fold(F.sort_array("items", asc=False), seed).alias("folded"))
        )
        folded = saved(folded, "mixing-folded")
        done = folded.select("source", F.explode("folded.done").alias("x")).select(
            "source", "x.key", "x.whole"
        )
        decided = done if decided is None else decided.union(done)
        open_items = folded.where("folded.left is not null").select(
            "source", "folded.left.key", "folded.left.words", "folded.left.part"
        )
        if most == 1:
            # One fraction per source: the nearer whole number, so that its target is missed by
            # half a document at most.
            nearer = (F.col("part") >= 0.5).cast("int").alias("whole")
            last = open_items.select("source", "key", nearer)
            decided = decided.union(last)
            break
        counts = open_items.groupBy("source").agg(F.count("*").alias("n"))
        most = min(counts.agg(F.max("n")).first()[0] or 0, most - 1)
    if decided is None:
        rounded = wanted.withColumn("whole", F.lit(0))
    else:
        decided = saved(
            decided.select(F.col("source").alias("of"), F.col("key").alias("of_item"), "whole"),
            "mixing-decided",
        )
        rounded = wanted.join(
            decided,
            (wanted["item"] == decided["of_item"]) & wanted["source"].eqNullSafe(decided["of"]),
            "left",
        )
    return rounded.select(
        "source",
        "key",
        "size",
        "rows",
        (F.col("base") + F.coalesce("whole", F.lit(0))).cast("long").alias("copies"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document.

    Null or empty texts have size 0 and give nothing. Rows equal in doc_id, source and size share
    their copies evenly, the first rows one more if it does not come out even. A null doc_id is
    a key like any other. Columns beside doc_id, text and source are ignored.
    """
    docs = table(spark, sf_dir, "documents")
    sized = saved(
        docs.select(F.col("doc_id").alias("key"), "source", words_in(F.col("text")).alias("size")),
        "mixing-sized",
    )
    targets = saved(source_targets(sized), "mixing-targets")
    taken = copies(sized, targets)
    each = taken.withColumn(
        "nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    )
    own = F.floor(F.col("copies") / F.col("rows")) + F.when(
        F.col("nth") <= F.col("copies") % F.col("rows"), 1
    ).otherwise(0)
    result = each.select("source", "key", "size", (own * F.col("size")).cast("long").alias("taken"))
    return result.join(targets, result["source"].eqNullSafe(targets["source"])).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (columns unchanged).

    Documents without words are not part of any target and are taken once.
    """
    sized = docs.withColumn("_mix_size", words_in(F.col("text")))
    narrow = saved(
        sized.select(F.col("doc_id").alias("key"), "source", F.col("_mix_size").alias("size")),
        "mixing-sized",
    )
    targets = saved(source_targets(narrow), "mixing-targets")
    taken = saved(copies(narrow, targets), "mixing-taken").select(
        F.col("source").alias("_mix_source"),
        F.col("key").alias("_mix_key"),
        F.col("size").alias("_mix_of"),
        F.col("rows").alias("_mix_rows"),
        F.col("copies").alias("_mix_copies"),
    )
    joined = sized.join(
        taken,
        sized["doc_id"].eqNullSafe(taken["_mix_key"])
        & (sized["_mix_size"] == taken["_mix_of"])
        & sized["source"].eqNullSafe(taken["_mix_source"]),
    )
    alike = W.partitionBy("_mix_key", "_mix_of", "_mix_source").orderBy("text")
    alone = joined.where("_mix_rows = 1").withColumn("_mix_nth", F.lit(1))
    shared = joined.where("_mix_rows > 1").withColumn("_mix_nth", F.row_number().over(alike))
    both = alone.unionByName(shared)
    own = F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + F.when(
        F.col("_mix_nth") <= F.col("_mix_copies") % F.col("_mix_rows"), 1
    ).otherwise(0)
    own = F.when(F.col("_mix_size") == 0, 1).otherwise(own).cast("int")
    return (
        both.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), own)))
        .select(named(docs))
    )
