"""SpotSigs fingerprints: chains of content words after common words.

A signature is a common word (the anchor) with the `chain` content words that follow it among the
next `reach` words. A text's fingerprint is the set of its signatures' hashes, written as a digest
of the sorted set; the likeness of two fingerprints is the Jaccard measure of the sets. In
`similar_pairs` only, sets fall into partitions by length, so that sets at a likeness of at least a
threshold lie in the same or in neighbouring partitions, and Jaccard is only worked out for sets
whose lengths allow it.

Texts without a complete chain take the chains at all words; texts with fewer words take the hash
of the whole text, so null and empty texts have equal fingerprints and others do not. All is done by
built-in expressions. Repeated rows are fingerprinted alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from igarape.llm.common import let, quantile_cuts
from igarape.llm.quality_rules import STOP_WORDS


def signatures(text: Column, chain: int = 2, reach: int = 8, anchors: list[str] | None = None) -> Column:
    """The sorted, distinct hashes of a text's signatures."""
    common = anchors or STOP_WORDS
    t = F.coalesce(text, F.lit(""))

    def after(words: Column, marked: Column, i: Column) -> Column:
        content = F.slice(F.filter(F.slice(marked, i + 2, reach), lambda w: w != ""), 1, chain)
        return let(content, lambda c: F.when(F.size(c) == chain, F.xxhash64(F.get(words, i), c)))

    def chains(words: Column) -> Column:
        def spotted(marked: Column) -> Column:
            each = F.transform(marked, lambda w, i: F.when(w == "", after(words, marked, i)))
            return F.filter(each, lambda h: h.isNotNull())

        marked = F.transform(words, lambda w: F.when(w.isin(*common), F.lit("")).otherwise(w))
        plain = F.transform(
            F.sequence(F.lit(0), F.size(words) - chain - 1), lambda i: F.xxhash64(F.slice(words, i + 1, chain + 1))
        )
        return let(
            let(marked, spotted),
            lambda found: F.when(F.size(found) > 0, found)
            .when(F.size(words) > chain, plain)
            .otherwise(F.array(F.xxhash64(t))),
        )

    words = F.filter(F.split(F.lower(t), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.sort_array(F.array_distinct(let(words, chains)))


def digest(found: Column) -> Column:
    """32 hex digits of a signature set."""
    halves = [F.lpad(F.lower(F.hex(h)), 16, "0") for h in (F.xxhash64(found), F.xxhash64(F.lit(1), found))]
    return F.concat(*halves)


def length_part(size: Column, least: float) -> Column:
    """Number of the partition of sets of a length: each spans a factor of 1 / `least`."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(least))).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two sets; where the lengths keep it below `least`, 0 without comparing them."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    whole = let(shared, lambda s: s / (F.size(a) + F.size(b) - s))
    if least <= 0:
        return whole
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return F.when(low >= F.lit(least) * high, whole).otherwise(F.lit(0.0))


def similar_pairs(sets: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness) of rows (id, sigs) with different sets at a likeness of at least `least`.

    Each set's rarest signatures, as many as a partner must share one of, are looked up in its
    own length partition and the next. Sets should be distinct (`digest`): equal ones are one row.
    """
    counts = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").count()
    each = sets.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig")).join(counts, "sig")
    ranked = each.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("count", "sig"))).alias("ranked"))
    prefix = F.slice("ranked", F.lit(1), (F.col("n") - F.ceil(F.lit(least) * F.col("n")) + 1).cast("int"))
    part = length_part(F.col("n"), least)
    keys = ranked.select("id", "n", part.alias("part"), F.explode(prefix).alias("key"))
    keys = keys.select("id", "n", "part", F.col("key.sig").alias("sig"))
    there = keys.select("id", "n", "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("part").alias("own"))
    a, b = keys.alias("a"), there.alias("b")
    fits = (F.col("b.own") < F.col("a.part")) | (F.col("a.id") > F.col("b.id"))
    near = F.least("a.n", "b.n") >= F.lit(least) * F.greatest("a.n", "b.n")
    on = (F.col("a.sig") == F.col("b.sig")) & (F.col("a.part") == F.col("b.part")) & fits & near
    pairs = a.join(b, on).select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()
    left = sets.select(F.col("id").alias("a"), F.col("sigs").alias("a_sigs"))
    right = sets.select(F.col("id").alias("b"), F.col("sigs").alias("b_sigs"))
    found = pairs.join(left, "a").join(right, "b")
    found = found.select("a", "b", likeness(F.col("a_sigs"), F.col("b_sigs"), least).alias("likeness"))
    return found.filter(F.col("likeness") >= least)


def _in_order(docs: DataFrame, blocks: int) -> tuple[DataFrame, Window]:
    """Rows (block, ghost, id, text) and a window in which each row is followed by the next one.

    Ids are cut into blocks at quantiles. A copy of the text that begins the next block ends each
    block as its ghost, and the first text of all ends the last; so no task sees more than a block.
    """
    spark = docs.sparkSession
    cuts = quantile_cuts(docs, "id", blocks, 0.25 / blocks)
    limits = F.array(*[F.lit(x) for x in cuts]) if cuts else F.array().cast("array<double>")
    steps = [1 << i for i in reversed(range(max(1, len(cuts)).bit_length()))]
    here = F.col("id").cast("double")
    block = F.aggregate(
        F.array(*[F.lit(x) for x in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(limits, at + step - 1) <= here, at + step).otherwise(at),
    )
    rows = docs.select(block.alias("block"), F.lit(0).alias("ghost"), "id", "text")
    least = rows.groupBy("block").agg(F.min("id").alias("least"), F.count_if(F.col("id").isNull()).alias("nulls"))
    begins = sorted((x["block"], None if x["nulls"] else x["least"]) for x in least.collect())
    firsts = [(value, begins[i - 1][0]) for i, (_, value) in enumerate(begins)]
    first = spark.createDataFrame(firsts, "first long, block int")
    # A row per block, so the texts are not shuffled to find those that begin blocks.
    ghosts = (
        docs.join(F.broadcast(first), F.col("id").eqNullSafe(F.col("first")))
        .groupBy("block")
        .agg(F.min("text").alias("text"))
        .select("block", F.lit(1).alias("ghost"), F.lit(None).cast("long").alias("id"), "text")
    )
    order = Window.partitionBy("block").orderBy("ghost", F.col("id").asc_nulls_first(), "text")
    return rows.unionByName(ghosts), order


def compare_with_edits(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", blocks: int | None = None
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the
    next text by id (after the last: of the first). Null ids come first; equal ids in the order
    of their texts.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, order = _in_order(plain, blocks)
    half = F.floor(F.length("text") / 2).cast("int")
    ahead = rows.withColumn("next_text", F.lead("text").over(order))
    edited = F.concat(
        F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half)
    )
    edits = ahead.select("block", "ghost", "id", "text", edited.alias("edited"))
    marked = edits.select(
        "block",
        "ghost",
        "id",
        "text",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("sigs"),
        F.when(F.col("ghost") == 0, signatures(F.col("edited"))).alias("edited_sigs"),
    )
    both = marked.withColumn("next_sigs", F.lead("sigs").over(order)).filter(F.col("ghost") == 0)
    return both.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        digest(F.col("sigs")).alias("fingerprint"),
        digest(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )
