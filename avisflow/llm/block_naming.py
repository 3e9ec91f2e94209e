"""Exact de-duplication by deterministic block naming (native: DataFrame functions only).

A text is cut into blocks of a fixed number of characters. All blocks of the corpus are sorted and
each distinct block is named by the place where it first stands in that order, so equal blocks and
only they share a name. Neighbouring names are then paired, the distinct pairs sorted and named in
the same way, and so on until every document holds one name; (level, name) is its identity. No two
different texts share it, since every step is an injective renaming and no hash decides anything.

Scale: the texts move once, into the range partitions of the block sort. The most frequent blocks
(at most ``HEAVY``, chosen by counted hashes, then compared as texts) are named through a broadcast
table of at most ``HEAVY`` blocks, so no range partition holds more than a small share of equal
rows. Pair rounds move integers only and halve their rows each time; the distinct pairs are
aggregated before the shuffle and joined back from a written table, where Spark splits hot pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from avisflow.llm.common import table

BLOCK_CHARS = 8192
HEAD_CHARS = 16
#: Most frequent blocks that are named by broadcast (bound of that table), and the least count of one.
HEAVY, HEAVY_LEAST = 1024, 64
NO_PARTNER = -(1 << 62)


def _blocks(text, chars: int):
    whole = F.array(text)
    return F.when(F.length(text) <= chars, whole).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0)))


def _name_blocks(src: DataFrame, chars: int) -> DataFrame:
    """One row per block: rid, doc_id, sha, n (blocks of the document), pos, name."""
    docs = src.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                      F.unhex(F.sha2("text", 256)).alias("sha"), _blocks(F.col("text"), chars).alias("blocks"))
    rows = docs.select("rid", "doc_id", "sha", F.size("blocks").alias("n"),
                       F.posexplode("blocks").alias("pos", "block"))
    counted = (src.select(F.explode(_blocks(F.col("text"), chars)).alias("block"))
               .groupBy(F.xxhash64("block").alias("h")).agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") >= HEAVY_LEAST).orderBy(F.col("n").desc(), "h").limit(HEAVY))
    hashes = [r["h"] for r in counted.collect()]
    cold = rows
    if hashes:
        heavy = (src.select(F.explode(_blocks(F.col("text"), chars)).alias("block"))
                 .where(F.xxhash64("block").isin(hashes)).distinct()
                 .select("block", (-F.row_number().over(W.orderBy(F.col("block").desc()))).cast("long").alias("name")))
        heavy = table(heavy, "heavy-blocks")
        cold = rows.join(F.broadcast(heavy.select("block")), "block", "left_anti")
    # Blocks are sorted by their first characters, a hash and the whole block; ranges are cut by the
    # first two, so the sample that Spark takes for them stays small. A range holds all rows of a
    # block; the sort inside it makes the row number an order.
    named = (cold.withColumns({"head": F.left("block", F.lit(HEAD_CHARS)), "h": F.xxhash64("block")})
             .repartitionByRange("head", "h").sortWithinPartitions("head", "h", "block", "rid", "pos")
             .withColumn("ord", F.monotonically_increasing_id())
             .withColumn("name", F.min("ord").over(W.partitionBy("head", "h", "block"))))
    cols = ["rid", "doc_id", "sha", "n", "pos", "name"]
    named = named.select(*cols)
    if hashes:
        named = named.unionByName(rows.join(F.broadcast(heavy), "block").select(*cols))
    return table(named, "block-names")


def _name_pairs(cur: DataFrame, level: int) -> DataFrame:
    """Pair neighbouring names and name the distinct pairs by their sorted place."""
    own = ["rid", "doc_id", "sha", "n"]
    pairs = (cur.groupBy(*own, F.expr("pos div 2").cast("int").alias("pos"))
             .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                  F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("b")))
    names = table(pairs.select("a", "b").distinct().repartitionByRange("a", "b").sortWithinPartitions("a", "b")
                  .withColumn("name", F.monotonically_increasing_id()), f"pair-names-{level}")
    return table(pairs.join(names, ["a", "b"]).select(*own, "pos", "name"), f"names-{level}")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, sha (binary), level, name per row: equal (level, name) exactly for equal texts."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cur = _name_blocks(src, block_chars)
    longest = cur.agg(F.max("n")).first()[0] or 1
    found = cur.where("n = 1").select("doc_id", "sha", F.lit(0).alias("level"), "name")
    cur, level = cur.where("n > 1"), 0
    while (1 << level) < longest:
        level += 1
        named = _name_pairs(cur, level)
        done = F.col("n") <= (1 << level)
        found = found.unionByName(named.where(done).select("doc_id", "sha", F.lit(level).alias("level"), "name"))
        cur = named.where(~done)
    return found


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row.

    Null texts count as empty; all empty texts are one group. Of equal texts the largest doc_id
    stays. Null ids are never the largest; a group of null ids only has keep_id null and all its
    rows are kept. Rows that repeat a doc_id count in group_size each and stay or go together.
    Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    ids = identities(docs, id_col, text_col, block_chars)
    groups = table(ids.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                   .where("group_size > 1"), "groups")
    out = ids.join(groups, ["level", "name"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
