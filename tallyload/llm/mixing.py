"""Operator 8: mixing sources to target weights, in DataFrame functions only.

Each source's words, document after document, are packed into blocks of a
fixed number of words.  The output is a row of shards of ``SLOTS`` slots.  A
source draws as many blocks as its target needs, rounded; one pseudorandom
permutation shuffles the draws of all sources over all slots.  So a shard's
source counts are multinomial under the condition that totals meet the targets,
and a shard's slots are in random order.  A source's k-th draw takes block
``permutation(k mod blocks)``, with another pseudorandom permutation for each
pass over the source.  Drawn blocks and documents meet in an equi-join on
(source, block).

No source is handled by one task: documents are numbered inside hashed buckets
whose sums are added up, draws come from a range of numbers, and blocks spread
over all partitions.  The driver reads one row of totals; sums over sources run
over one row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyload.llm.common import WORD, Scratch

SLOTS = 1024
_CELLS = 4096
_ROUNDS = 8


def source_targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """``(source, source_no, source_size, target)`` of each source; ``sizes``: source, source_size.

    Weights go round by code point order of the sources, null last.  Targets
    are proportional to the weights up to ``cap`` times the source's size, and
    what is above that goes to the others by weight.  A source is at its cap if
    its cap by weight is not above the level that is left once all sources with
    a smaller cap by weight are at theirs.  There is one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.lit([float(x) for x in weights])
    s = sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
    s = s.withColumn("w", F.element_at(w, (F.col("source_no") % len(weights) + 1).cast("int"))).withColumn(
        "cap", F.col("source_size") * F.lit(float(cap)))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(share))).withColumn(
        "all_w", F.sum("w").over(everything))
    left = F.col("all_words") - F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0))
    s = s.withColumn("left", left).withColumn("left_w", F.col("all_w") - F.coalesce(F.sum("w").over(by_cap), F.lit(0.0)))
    s = s.withColumn("full", F.col("cap") / F.col("w") <= F.col("left") / F.col("left_w"))
    words = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    used = F.sum(F.when(F.col("full"), F.col("w")).otherwise(0.0)).over(everything)
    level = F.try_divide(F.col("all_words") - words, F.col("all_w") - used)
    return s.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * level)).select(
        "source", "source_no", "source_size", "target")


def _before(df: DataFrame, key: str, index: str, value: str, out: str, group: int = 4096) -> DataFrame:
    """Sum of ``value`` over the rows of the same key with a smaller index, in two levels."""
    df = df.withColumn("_g", F.floor(F.col(index) / group))
    inside = Window.partitionBy(key, "_g").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    groups = df.groupBy(key, "_g").agg(F.sum(value).alias("_sum"))
    above = Window.partitionBy(key).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(key, "_g", F.coalesce(F.sum("_sum").over(above), F.lit(0)).alias("_base"))
    df = df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return df.join(groups, [key, "_g"]).withColumn(out, F.col("_base") + F.col("_in")).drop("_g", "_in", "_base")


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """Image of ``index`` (0 to n - 1) in a keyed pseudorandom permutation of 0 to n - 1.

    A swap-or-not shuffle: each round pairs x with (k - x) mod n and a hash of
    the pair decides whether to swap, which is a bijection for every n.
    """
    def turn(x, r):
        pair = F.pmod(F.pmod(F.xxhash64(r, *key), n) - x, n)
        swap = lambda y: F.xxhash64(-r, *key, F.greatest(x, y)) % 2 == 0
        return F.element_at(F.transform(F.array(pair), lambda y: F.when(swap(y), y).otherwise(x)), 1)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), index, turn)


def _mix(docs: DataFrame, weights, share, cap, block, seed, id_col, text_col, source_col, key_col
         ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Slots with their blocks, documents with their first words, and documents by block with the words of each there."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    key = F.col(f"`{key_col}`") if key_col else F.lit(None)
    sized = scratch.table(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), key.cast("long").alias("key"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    sources = scratch.table(source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n")).drop("_n"),
        list(weights), share, cap), "sources")
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    s = sources.select("source_no", blocks.alias("blocks"),
                       F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)).alias("r")).withColumn(
        "n", F.least(F.round(F.col("r") * F.col("blocks")), F.col("blocks") * cap).cast("long"))
    totals = s.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("sources")).head()
    n_rows = sized.count()
    n_slots, n_cells = totals["n"], _CELLS + 4 * totals["sources"]

    # a source has a range of draws, cut where a cell ends, so that draws find it by an equi-join
    upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = s.where("n > 0").withColumn("hi", F.sum("n").over(upto)).withColumn("lo", F.col("hi") - F.col("n"))
    cells = shares.select("source_no", "blocks", "lo", "hi", F.explode(F.sequence(
        F.expr(f"lo * {n_cells} div {max(n_slots, 1)}"), F.expr(f"(hi - 1) * {n_cells} div {max(n_slots, 1)}"))).alias("cell"))
    draws = spark.range(n_slots).withColumn("cell", F.expr(f"id * {n_cells} div {max(n_slots, 1)}"))
    draws = draws.join(cells, "cell").where("id >= lo AND id < hi").withColumn("k", F.col("id") - F.col("lo"))
    # all draws are shuffled over all slots
    place = permuted(F.col("id"), F.lit(n_slots), F.lit(seed), F.lit(-1).cast("long"))
    draws = draws.select("source_no", "blocks", F.expr("k div blocks").alias("pass"), (F.col("k") % F.col("blocks")).alias("block"), place.alias("place"))
    image = permuted(F.col("block"), F.col("blocks"), F.lit(seed), F.col("source_no"), F.col("pass"))
    slots = draws.select(F.expr(f"place div {SLOTS}").alias("shard"), (F.col("place") % SLOTS).cast("int").alias("slot"), "source_no", "pass",
                         image.alias("block"))

    # first word of each document in its source
    buckets = max(1, -(-n_rows // 4096))
    d = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    d = d.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_hash"), F.lit(buckets)))
    inside = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "size", "text_hash", "key").rowsBetween(Window.unboundedPreceding, -1)
    base = _before(d.groupBy("source_no", "bucket").agg(F.sum("size").alias("_words")), "source_no", "bucket", "_words", "_start")
    d = (d.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
         .join(base.select("source_no", "bucket", "_start"), ["source_no", "bucket"])
         .withColumn("first", F.col("_start") + F.col("_in"))
         .select("doc_id", "key", "source", "source_no", "source_size", "target", "size", "first"))
    full = d.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.expr(f"first div {block}"), F.expr(f"(first + size - 1) div {block}"))))
    start = F.greatest(F.col("block") * block - F.col("first"), F.lit(0)).cast("long")
    end = F.least((F.col("block") + 1) * block - F.col("first"), F.col("size"))
    return slots, d, full.withColumn("start", start).withColumn("words", end - start)


def mix_sources(docs: DataFrame, weights: list[int] = (5, 2, 1), share: float = 1.5, cap: int = 2, block: int = 64,
                seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                key_col: str | None = None) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row, with ``key_col`` also its ``key``.

    ``taken`` is the number of the document's words in the mix, repeats
    counted; at most ``cap`` times its size.  Null and empty texts have size 0
    and take nothing.  Null is a source of its own, last in order.  Null ids
    are kept; repeated rows are separate documents, in the order of their
    texts' hashes, and of ``key_col`` (a number of each row) if that is given.
    Equal inputs give equal results.  Empty tables give empty results.  Other columns are ignored.
    """
    slots, d, full = _mix(docs, weights, share, cap, block, seed, id_col, text_col, source_col, key_col)
    times = slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    out = (full.join(times, ["source_no", "block"], "left")
           .groupBy("source_no", "first", "doc_id", "key", "source", "size", "source_size", "target")
           .agg(F.sum(F.coalesce(F.col("times"), F.lit(0)) * F.col("words")).alias("taken")))
    cols = ["doc_id", *(["key"] if key_col else []), "source", "size", "source_size", "target", "taken"]
    return out.select(*cols).unionByName(d.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*cols))


def mix_slots(docs: DataFrame, weights: list[int] = (5, 2, 1), share: float = 1.5, cap: int = 2, block: int = 64,
              seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              key_col: str | None = None) -> DataFrame:
    """The mix: ``(shard, slot, source, pass, block, doc_id, key, size, start, words)``.

    A row for every document that has words in the block of a slot: ``words``
    words from word ``start`` of its ``size``.  A source's passes follow each
    other, so only its last one is partial.  ``taken`` of ``mix_sources`` is the
    sum of a document's ``words``.
    """
    slots, _, full = _mix(docs, weights, share, cap, block, seed, id_col, text_col, source_col, key_col)
    return full.join(slots, ["source_no", "block"]).select("shard", "slot", "source", "pass", "block", "doc_id", "key", "size", "start", "words")


def cut_words(text: Column, ranges: Column) -> Column:
    """The words of ``ranges`` (an array of start and words, in order) with the space that follows each."""
    space = r"[\x20\x09-\x0D]*"
    lead = F.when(F.element_at(ranges, 1)["start"] == 0, F.regexp_extract(text, "^" + space, 0)).otherwise(F.lit(""))
    cut = lambda pieces: F.array_join(F.transform(ranges, lambda r: F.array_join(
        F.slice(pieces, r["start"].cast("int") + 1, r["words"].cast("int")), "")), "")
    return F.concat(lead, F.element_at(F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD + space), F.lit(0))), cut), 1))
