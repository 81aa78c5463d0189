"""Mixing sources to target weights, by blocks.

The words of each source, its documents end to end, are packed into blocks of
a fixed number of words (fewer words in sources of a few blocks, so that their
targets can be met by whole blocks). The mix has output shards of slots; every slot draws
its source with the targets' odds, so a shard's counts are multinomial. Counts
beyond a source's quota go, in order, to the sources that fell short. A
source's k-th slot takes block ``perm(k mod blocks)`` of pass ``k div blocks``,
where ``perm`` is a keyed permutation of the block numbers (swap-or-not
rounds), and blocks are joined by that number. Only DataFrame functions run.

No window holds a source: rows are ordered by a hash bucket first, buckets and
shards are summed before their running sums, and the rest is joins on
(source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import run_dir, written

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a hash bucket, about; the running sum inside one is a window.
BUCKET_ROWS = 2_000
ROUNDS = 10
#: Numbers of a running sum that are summed as one first.
STRETCH = 4096
#: A source has so many blocks at least, if it has the words.
LEAST_BLOCKS = 32


def _swaps(index: Column, n: Column, rounds: Column, *key: Column) -> Column:
    def swap(x: Column, r: Column) -> Column:
        y = F.pmod(F.pmod(F.xxhash64(r, *key), n) - x, n)
        return F.when(F.pmod(F.xxhash64(F.greatest(x, y), r, *key), F.lit(2)) == 0, x).otherwise(y)
    return F.aggregate(rounds, index, swap)


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """Place of ``index`` under a keyed permutation of 0..n-1, for any n."""
    return _swaps(index, n, F.sequence(F.lit(1), F.lit(ROUNDS)), *key)


def unpermuted(place: Column, n: Column, *key: Column) -> Column:
    """The index that ``permuted`` takes to ``place``: each round undoes itself."""
    return _swaps(place, n, F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)), *key)


def running_before(rows: DataFrame, group: list[str], order: str, value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over the group's rows before this one; ``order`` is a dense number from 0.

    Stretches of STRETCH numbers are summed first, so a window holds at most a
    stretch, or one row per stretch.
    """
    cut = rows.withColumn("_stretch", F.floor(F.col(order) / STRETCH))
    sums = cut.groupBy(*group, "_stretch").agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_start", F.sum("_sum").over(Window.partitionBy(*group).orderBy("_stretch")) - F.col("_sum"))
    inside = F.sum(value).over(Window.partitionBy(*group, "_stretch").orderBy(order))
    return cut.withColumn("_upto", inside).join(sums.drop("_sum"), [*group, "_stretch"]).withColumn(
        out, F.col("_start") + F.col("_upto") - F.col(value)).drop("_stretch", "_start", "_upto")


def sources_of(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row per source: number, source_size, target.

    Sources in code point order, null last, weigh ``weights`` in turn and
    share ``share`` of all sizes; no target passes ``cap`` times its source's
    size, and the excess is shared again by weight until none is above. That
    is the level L with sum(min(cap * size, L * weight)) = the total.
    """
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: the two running sums are over sources, not over data
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    each = each.withColumn("number", F.row_number().over(by_name).cast("long"))
    each = each.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                  (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int")))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "number")
    each = each.withColumns({
        "total": F.sum("source_size").over(everything) * F.lit(float(share)), "most": F.col("source_size") * F.lit(float(cap)),
        "_before": F.coalesce(F.sum(F.col("source_size") * F.lit(float(cap))).over(
            by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_weights": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))})
    each = each.withColumn("_level", (F.col("total") - F.col("_before")) / F.col("_weights"))
    # below the level sources are full; the first that isn't sets it
    each = each.withColumn("level", F.min(F.when(F.col("most") / F.col("weight") > F.col("_level"),
                                                 F.struct(F.col("source_size") / F.col("weight"), "number",
                                                          F.col("_level").alias("l")))).over(everything)["l"])
    target = F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return each.select("source", "number", "source_size", target.alias("target"))


def sized_rows(docs: DataFrame, doc_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(doc_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.xxhash64(text_col).alias("text_hash"), size.alias("size"))


class Mix:
    """A mix of ``docs``; deterministic in the rows and the parameters.

    ``rows``: doc_id, text_hash, source number, size, first (place of its
    first word in its source). ``sources``: see ``sources_of``, with ``width``
    (words of a block: ``block_words``, less in a source that has not
    LEAST_BLOCKS such blocks), ``blocks`` and ``quota``, the number of slots
    whose words come nearest to the target: the last block of a source counts
    by its own words. ``slots``: shard, source number, turn (of that source),
    pass and block. Null texts have size 0, a null source is a source of its
    own (the last); a source without words has target 0 and no slots; repeated
    rows are documents of their own, as alike as rows can be; an empty table
    gives empty parts. Columns beyond the three named are not read.
    """

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                 block_words: int = 64, shard_slots: int = 4096, seed: int = 7,
                 doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
        spark = docs.sparkSession
        folder = run_dir(spark, "mix")
        self.block_words = block_words
        sized = written(sized_rows(docs, doc_col, text_col, source_col), folder, "sized")
        buckets = max(1, sized.count() // BUCKET_ROWS)
        sources = self._quotas(sources_of(sized, weights, share, cap), block_words, seed)
        ordered = Window.orderBy("number")
        sources = sources.withColumn("high", F.sum("quota").over(ordered)).withColumn("low", F.col("high") - F.col("quota"))
        self.sources = sources = written(sources.coalesce(1), folder, "sources")

        rows = sized.join(sources.select(F.col("source").alias("_source"), "number", "width"),
                          F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(buckets)))
        sums = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
        sums = running_before(sums, ["number"], "bucket", "words", "before")
        inside = Window.partitionBy("number", "bucket").orderBy("doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_upto", F.sum("size").over(inside)).join(sums.drop("words"), ["number", "bucket"])
        self.rows = written(rows.select("doc_id", "text_hash", "number", "size", "width",
                                        (F.col("before") + F.col("_upto") - F.col("size")).alias("first")), folder, "rows")
        self.slots = written(self._slots(spark, folder, shard_slots, seed), folder, "slots")

    @staticmethod
    def _quotas(sources: DataFrame, block_words: int, seed: int) -> DataFrame:
        size = F.col("source_size")
        width = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(size / LEAST_BLOCKS))).cast("long")
        sources = sources.withColumn("width", width).withColumn("blocks", F.ceil(size / F.col("width")).cast("long"))
        some = F.col("blocks") > 0
        passes = F.when(some, F.floor(F.col("target") / size)).otherwise(0).cast("long")
        sources = sources.withColumns({"_passes": passes, "_rest": F.when(some, F.col("target") - passes * size).otherwise(0.0)})
        # in the last pass, the turn that takes the short block
        short = F.when(some, unpermuted(F.col("blocks") - 1, F.col("blocks"), F.col("number"), F.col("_passes"), F.lit(seed)))
        sources = sources.withColumn("_short", short)
        missing = F.col("blocks") * F.col("width") - size
        near = [F.least(F.col("blocks"), F.floor(F.col("_rest") / F.col("width")) + k) for k in range(3)]
        far = [F.abs(n * F.col("width") - F.when(F.col("_short") < n, missing).otherwise(0) - F.col("_rest")) for n in near]
        best = F.least(*[F.struct(f.alias("far"), n.cast("long").alias("n")) for f, n in zip(far, near)])["n"]
        return sources.withColumn("quota", F.when(some, F.col("_passes") * F.col("blocks") + best).otherwise(0).cast("long")).drop(
            "_passes", "_rest", "_short")

    def _slots(self, spark, folder: str, shard_slots: int, seed: int) -> DataFrame:
        sources = self.sources
        n = sources.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]
        # a draw falls into one of the cells that its source's stretch of 0..n-1 covers
        width = max(1, -(-n // 1024))
        cells = sources.where("quota > 0").select("number", "low", "high", F.explode(
            F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
        draws = spark.range(n).select(F.floor(F.col("id") / shard_slots).alias("shard"),
                                      F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(n, 1))).alias("x"))
        drawn = draws.withColumn("cell", F.floor(F.col("x") / width)).join(cells, "cell").where("x >= low and x < high")
        drawn = drawn.groupBy("shard", "number").agg(F.count(F.lit(1)).alias("drawn"))
        drawn = running_before(drawn, ["number"], "shard", "drawn", "_before").join(sources.select("number", "quota"), "number")
        take = F.greatest(F.lit(0), F.least(F.col("drawn"), F.col("quota") - F.col("_before")))
        drawn = written(drawn.withColumn("take", take), folder, "drawn")
        # a shard's draws are few rows here and many slots below: deal them before they are expanded
        dealt = drawn.where("take > 0").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "number")
        main = dealt.select("shard", "number", F.explode(
            F.sequence(F.col("_before"), F.col("_before") + F.col("take") - 1)).alias("turn"))
        # slots over quota, and turns still due, both numbered and joined by number
        over = drawn.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("take")).alias("n")).where("n > 0")
        over = running_before(over.withColumn("_all", F.lit(0)), ["_all"], "shard", "n", "_begin")
        over = over.select("shard", F.explode(F.sequence(F.col("_begin"), F.col("_begin") + F.col("n") - 1)).alias("i"))
        due = sources.join(drawn.groupBy("number").agg(F.sum("take").alias("taken")), "number", "left").select(
            "number", F.coalesce("taken", F.lit(0)).alias("taken"), "quota").where("quota > taken")
        due = due.withColumn("n", F.col("quota") - F.col("taken")).withColumn("_end", F.sum("n").over(Window.orderBy("number")))
        due = due.select("number", F.posexplode(F.sequence(F.col("_end") - F.col("n"), F.col("_end") - 1)).alias("p", "i"),
                         "taken").select("i", "number", (F.col("taken") + F.col("p")).alias("turn"))
        turns = main.unionByName(over.join(due, "i").select("shard", "number", "turn"))
        turns = turns.join(sources.select("number", "blocks"), "number").withColumn(
            "pass", F.floor(F.col("turn") / F.col("blocks")))
        block = permuted(F.pmod("turn", "blocks"), F.col("blocks"), F.col("number"), F.col("pass"), F.lit(seed))
        return turns.select("shard", "number", "turn", "pass", block.alias("block"))

    def pieces(self) -> DataFrame:
        """One row per document and block that it reaches into: begin and end are word places in the document."""
        b = F.col("width")
        cut = self.rows.where("size > 0").select("*", F.explode(F.sequence(
            F.floor(F.col("first") / b), F.floor((F.col("first") + F.col("size") - 1) / b))).alias("block"))
        begin = F.greatest(F.lit(0), F.col("block") * b - F.col("first"))
        end = F.least(F.col("size"), (F.col("block") + 1) * b - F.col("first"))
        return cut.withColumns({"begin": begin, "end": end})

    def per_document(self) -> DataFrame:
        """doc_id, text_hash, source, size, source_size, target, taken (words the mix takes, repeats counted)."""
        times = self.slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
        taken = self.pieces().join(times, ["number", "block"]).select(
            "doc_id", "text_hash", "number", "size", "first", ((F.col("end") - F.col("begin")) * F.col("times")).alias("taken"))
        nothing = self.rows.select("doc_id", "text_hash", "number", "size", "first", F.lit(0).cast("long").alias("taken"))
        # empty rows at one place are alike; their count says how many there are
        each = taken.unionByName(nothing).groupBy("doc_id", "text_hash", "number", "size", "first").agg(
            F.sum("taken").alias("taken"), F.sum(F.when(F.col("taken") == 0, 1).otherwise(0)).alias("_rows"))
        each = each.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("size") == 0, F.col("_rows")).otherwise(1))))
        return each.join(self.sources.select("number", "source", "source_size", "target"), "number").select(
            "doc_id", "text_hash", "source", "size", "source_size", "target", "taken")

    def blocks(self, docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The mix itself: shard, source, turn, block, n_words and text (its words joined by one space)."""
        words = docs.select(F.col(doc_col).alias("_id"), F.xxhash64(text_col).alias("_hash"),
                            F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(WORD), F.lit(0)).alias("_words"))
        words = words.dropDuplicates(["_id", "_hash"])
        cut = self.pieces().join(words, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
        cut = cut.select("number", "block", "first", "begin", F.slice(
            "_words", (F.col("begin") + 1).cast("int"), (F.col("end") - F.col("begin")).cast("int")).alias("words"))
        # a block has block_words words at most, so its list is bounded
        packed = cut.groupBy("number", "block").agg(F.sort_array(F.collect_list(
            F.struct((F.col("first") + F.col("begin")).alias("at"), "words"))).alias("parts"))
        packed = packed.withColumn("words", F.flatten(F.transform("parts", lambda p: p["words"]))).select(
            "number", "block", F.size("words").alias("n_words"), F.array_join("words", " ").alias("text"))
        return self.slots.join(packed, ["number", "block"]).join(self.sources.select("number", "source"), "number").select(
            "shard", "source", "turn", "block", "n_words", "text")
