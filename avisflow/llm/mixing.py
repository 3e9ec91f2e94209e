"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of about equal word counts by a seeded hash of its documents. Its
target is met by whole passes over its blocks plus a prefix of their seeded permutation (the last
block up to a document). The exact block quotas of all sources are then split recursively among the
output shards: each node hands half of its blocks to its left child, their composition drawn from
the multivariate hypergeometric distribution, so every shard gets blocks in the mixture's
proportions and no block twice. Within a shard, documents are shuffled by a hash.

Scale: words are counted and summed per block before the shuffle. The plan is one row per source
and block, at most ``MAX_BLOCKS`` plus two per source whatever the input's size (blocks grow with
the corpus); only it visits the driver and is broadcast. Applying it to the documents is a map:
texts move only when a caller writes the mix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from avisflow.llm.common import slices, table, text_bytes

WEIGHTS, SHARE, MOST_PASSES, SEED = (3.0, 1.0, 2.0), 1.5, 2, 7
#: Blocks a shard gets on average, words of a block at least, blocks of the corpus at most.
SHARD_BLOCKS, BLOCK_WORDS, MAX_BLOCKS = 32, 65536, 262144


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """doc_id, source, place, size: words are what stands between ASCII white space; a null text has none."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 3):
                sizes = pa.array([len(t.split()) for t in text_bytes(part.column(3))], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], sizes], names=["doc_id", "source", "place", "size"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      _place(id_col, text_col, seed).alias("place"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, source string, place long, size long")


def capped_targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: float) -> np.ndarray:
    """``total`` shared by weight; targets stop at ``most`` times their size, the excess is shared
    again by weight among the others until none is above."""
    cap = sizes * float(most)
    out = np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    left = float(total)
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share >= cap)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = cap[over]
        left -= cap[over].sum()
        free &= ~over
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): the quotas dealt out by a tree of multivariate hypergeometric draws."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    total = int(quotas.sum())
    drawn = rng.multivariate_hypergeometric(quotas, total * left // shards, method="marginals")
    return np.concatenate([split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)])


def _place(id_col: str, text_col: str, seed: int):
    """A document's seeded place in its source's permutation, from its id and text: rows that share an
    id, or have none, do not share a place."""
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def _block(place, n_blocks):
    return F.pmod(F.shiftrightunsigned(place, 11), n_blocks)


def _cut_rows(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with words of the partly taken blocks: at most as many as a block has words; rows without
    words do not change the running sum."""
    at = (F.col("src") == F.col("c_src")) & (F.col("block") == F.col("c_block"))
    return keyed.where(F.col("size") > 0).join(F.broadcast(cuts), at)


def plan(sized: DataFrame, place_col: str, source_col: str, size_col: str, weights=WEIGHTS, share: float = SHARE,
         most: int = MOST_PASSES, shards: int | None = None, seed: int = SEED, block_words: int = BLOCK_WORDS,
         max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per source and block: source, block, n_blocks, source_size, target, the shards its
    passes go to, and, for a partly taken block, the place up to which documents take one more."""
    spark = sized.sparkSession
    rows = sized.select(F.col(source_col).alias("source"), F.col(size_col).alias("size"), F.col(place_col).alias("place"))
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).collect()
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = np.array([r["size"] for r in totals], np.int64)
    n = len(totals)
    goal = capped_targets(sizes, np.resize(np.array(weights, float), n), share * sizes.sum(), most)
    per_block = max(block_words, int(np.ceil(sizes.sum() / max_blocks))) if n else block_words
    blocks = np.maximum(1, sizes // per_block)
    names = spark.createDataFrame(
        [(r["source"], i, int(b)) for i, (r, b) in enumerate(zip(totals, blocks))],
        "p_source string, src int, n_blocks long")
    keyed = (rows.join(F.broadcast(names), F.col("source").cast("string").eqNullSafe(F.col("p_source")))
             .withColumn("block", _block(F.col("place"), F.col("n_blocks"))))
    held = keyed.groupBy("src", "block").agg(F.sum("size").alias("words")).toPandas()
    words = [np.zeros(b, np.int64) for b in blocks]
    for s, b, w in zip(held["src"], held["block"], held["words"]):
        words[s][b] = w
    rng = np.random.default_rng(seed)
    passes = np.where(sizes > 0, np.floor_divide(goal, np.maximum(sizes, 1)), 0).astype(np.int64)
    order, full, part, missing = [], [], [], []
    for s in range(n):
        order.append(rng.permutation(int(blocks[s])))
        run = np.cumsum(words[s][order[s]])
        rest = goal[s] - passes[s] * sizes[s]
        k = int(np.searchsorted(run, rest, "right"))  # blocks that fit whole
        full.append(k)
        missing.append(rest - (run[k - 1] if k else 0))
        part.append(int(order[s][k]) if k < blocks[s] and missing[s] > 0 else -1)
    # Within the one partly taken block of a source, documents in order of their place up to the target.
    cuts = spark.createDataFrame([(s, p, float(m)) for s, (p, m) in enumerate(zip(part, missing)) if p >= 0],
                                 "c_src int, c_block long, need double")
    inside = _cut_rows(keyed, cuts)
    run = W.partitionBy("src").orderBy("place").rangeBetween(W.unboundedPreceding, W.currentRow)
    upto = (inside.withColumn("run", F.sum("size").over(run))
            .where(F.abs(F.col("run") - F.col("need")) < F.col("need"))  # nearer to the target than taking none
            .groupBy("src").agg(F.min_by("place", F.struct(F.abs(F.col("run") - F.col("need")), "place")).alias("upto")).collect())
    upto = {r["src"]: r["upto"] for r in upto}
    quotas = np.array([int(passes[s] * blocks[s]) + full[s] + (s in upto) for s in range(n)], np.int64)
    shards = shards or max(1, int(quotas.sum()) // SHARD_BLOCKS)
    dealt = split_quotas(quotas, shards, np.random.default_rng(seed + 1)) if n else np.zeros((shards, 0), np.int64)
    out = []
    for s in range(n):
        units = np.concatenate([np.arange(blocks[s])] * int(passes[s]) + [order[s][:full[s]]]
                               + ([[part[s]]] if s in upto else [])).astype(np.int64)
        last = len(units) - 1 if s in upto else -1  # the partly taken unit
        shard_of = np.repeat(np.arange(shards), dealt[:, s])
        shard_of = shard_of[np.random.default_rng([seed + 2, s]).permutation(len(units))]  # disjoint draws of permuted blocks
        homes: dict[int, list[int]] = {}
        extra = {}
        for j, (b, h) in enumerate(zip(units.tolist(), shard_of.tolist())):
            if j == last:
                extra[b] = h
            else:
                homes.setdefault(b, []).append(h)
        for b in range(int(blocks[s])):
            out.append((totals[s]["source"], b, int(blocks[s]), int(sizes[s]), float(goal[s]), homes.get(b, []),
                        extra.get(b), upto.get(s) if b in extra else None))
    schema = T.StructType([T.StructField(k, t) for k, t in (
        ("p_source", T.StringType()), ("p_block", T.LongType()), ("p_blocks", T.LongType()), ("p_size", T.LongType()),
        ("p_target", T.DoubleType()), ("p_shards", T.ArrayType(T.IntegerType())), ("p_extra", T.IntegerType()),
        ("p_upto", T.LongType()))])
    return spark.createDataFrame(out, schema)


def apply_plan(rows: DataFrame, chosen: DataFrame, place, source_col: str) -> DataFrame:
    """``rows`` with p_source_size, p_target and p_copies, the shards a row's copies go to."""
    names = chosen.select("p_source", "p_blocks", F.col("p_size").alias("p_source_size"), "p_target").distinct()
    src = F.col(source_col).cast("string")
    keyed = (rows.join(F.broadcast(names), src.eqNullSafe(F.col("p_source")))
             .withColumn("p_place", place)
             .withColumn("p_own_block", _block(F.col("p_place"), F.col("p_blocks"))).drop("p_source", "p_blocks", "p_target"))
    plain = chosen.select("p_source", "p_block", "p_target", "p_shards", "p_extra", "p_upto")
    extra = F.when(F.col("p_extra").isNotNull() & (F.col("p_place") <= F.col("p_upto")), F.array("p_extra")).otherwise(
        F.array().cast("array<int>"))
    return (keyed.join(F.broadcast(plain), src.eqNullSafe(F.col("p_source")) & (F.col("p_own_block") == F.col("p_block")))
            .withColumn("p_copies", F.concat("p_shards", extra)))


def mix_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, shards: one row per input row.

    size counts the words of the text (null: 0); taken = size times the copies the mix takes, at
    most twice. Sources stand in code point order, a null source last; a source without words has
    target 0 and its documents are taken as its passes say, which counts nothing. Rows that repeat
    both id and text in a source are taken alike. Reruns agree. An empty table gives no rows.
    """
    sized = table(word_counts(docs, id_col, text_col, source_col, options.get("seed", SEED)), "sizes")
    chosen = plan(sized, "place", "source", "size", **options)
    out = apply_plan(sized, chosen, F.col("place"), "source")
    return out.select("doc_id", "source", "size", F.col("p_source_size").alias("source_size"), F.col("p_target").alias("target"),
                      (F.col("size") * F.size("p_copies")).alias("taken"), F.col("p_copies").alias("shards"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` (all columns, a row once per copy), dealt to shards and
    shuffled within each. See ``mix_table`` for the rules."""
    sized = table(word_counts(docs, id_col, text_col, source_col, seed), "sizes")
    chosen = plan(sized, "place", "source", "size", seed=seed, **options)
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"d_{i}" for i, c in enumerate(docs.columns)}
    dealt = (apply_plan(renamed, chosen, _place(at[id_col], at[text_col], seed), at[source_col])
             .select("*", F.posexplode("p_copies").alias("p_copy", "p_shard")))
    shuffled = F.xxhash64(F.lit(seed + 3), "p_place", "p_copy")
    shards = chosen.agg(F.max(F.greatest(F.array_max("p_shards"), "p_extra"))).first()[0]
    return (dealt.repartitionById((shards or 0) + 1, "p_shard").sortWithinPartitions("p_shard", shuffled)
            .select(*[F.col(f"d_{i}").alias(c) for i, c in enumerate(docs.columns)]))
