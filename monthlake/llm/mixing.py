"""Mixing sources to target weights with hash-threshold histograms, in DataFrame functions only.

Every document gets a 48-bit hash. A source that has to give r times its size gives each document
floor(r) times, and once more those whose hash lies below the source's threshold. The threshold is
found without sorting documents: sizes are summed by (source, hash bucket), the bucket where the
running sum passes the budget is found, and only its documents are summed again by the next bits.
After two levels a boundary bucket holds one document in 2^24 of its source; there the full hash
decides. Whole documents are taken, so a source misses its target by half of one document at most
(by half of the group, where rows share id and text).

Histograms combine on the map side; no step needs all rows of a source in one task. Per-source
tables are joined by `dimension`, which broadcasts only after a size check.

Defined cases: null text has size 0 and is never taken; a null source is a source of its own, last
in order; rows that repeat id and text share one decision; an empty table gives an empty result;
extra columns survive `mixed_rows` and are dropped by `mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthlake.llm import text as tx
from monthlake.plans.joins import dimension
from monthlake.session import shared_folder

LEVEL = 12  # bits of a histogram level
LEVELS = 2
HASH_BITS = 48
MAX_REPEAT = 3


def doc_hash(doc_id: Column, text: Column, seed: str = "") -> Column:
    """48 bits of the md5 of seed, id and text; the same on every run and engine."""
    parts = F.concat(
        F.lit(seed),
        F.coalesce(doc_id.cast("string"), F.lit("")),
        F.lit("\x1f"),
        F.coalesce(text, F.lit("")),
    )
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def rotating_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Sources by code point, null last, weigh 1, 2, .. `cycle`, repeating."""
    order = W.orderBy(F.col("_src").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("double"))


def targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Target of each source (`_src`, `source_size`, `weight`): its share of all sizes by weight,
    at most max_repeat times its size, the excess shared again by weight.

    A source reaches its cap before every source with a larger cap per weight. So the capped ones
    are a prefix in that order, and one running sum finds it. One row per source goes through here.
    """
    every = W.partitionBy(F.lit(0))
    cap, weight = F.col("_cap"), F.col("weight")
    order = every.orderBy(cap / weight, F.col("_src"))
    before, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum(weight).over(onward)
    first_free = F.min(F.when(cap > F.col("_level") * weight, F.struct("_rank", "_level"))).over(every)
    return (
        sizes.withColumn("_cap", (max_repeat * F.col("source_size")).cast("double"))
        .withColumn("_rank", F.row_number().over(order))
        .withColumn("_level", level)
        .withColumn("_free", first_free)
        .withColumn(
            "target",
            F.when(F.col("_free").isNull() | (F.col("_rank") < F.col("_free._rank")), cap).otherwise(
                F.col("_free._level") * weight
            ),
        )
        .drop("_cap", "_rank", "_level", "_free")
    )


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}._src").eqNullSafe(F.col(f"{b}._src"))


def thresholds(slim: DataFrame, plan: DataFrame) -> DataFrame:
    """The hash below which documents of a source give one more copy.

    `slim`: _src, _hash, size. `plan`: _src and budget (what is left after whole copies). Adds
    `below` to the plan: hashes smaller than it are taken.
    """
    state = plan.withColumn("_prefix", F.lit(0).cast("long")).withColumn("_spent", F.lit(0).cast("long"))
    known = 0
    for _ in range(LEVELS):
        bits = HASH_BITS - known - LEVEL
        inside = slim.alias("d").join(dimension(state).alias("s"), _same_source("d", "s"))
        if known:
            inside = inside.filter(F.shiftright("_hash", HASH_BITS - known) == F.col("_prefix"))
        sums = inside.groupBy("s._src", F.shiftright("_hash", bits).alias("_bucket")).agg(F.sum("size").alias("_size"))
        run = F.sum("_size").over(W.partitionBy("_src").orderBy("_bucket"))
        # The last bucket that starts within the budget; buckets that fit whole lie before it.
        edge = (
            sums.withColumn("_before", run - F.col("_size"))
            .alias("h")
            .join(dimension(state).alias("s"), _same_source("h", "s"))
            .filter(F.col("_before") + F.col("_spent") <= F.col("budget"))
            .groupBy("s._src", "s.budget", "s._spent")
            .agg(F.max(F.struct("_bucket", "_before")).alias("_e"))
        )
        state = edge.select(
            "_src", "budget", F.col("_e._bucket").alias("_prefix"), (F.col("_spent") + F.col("_e._before")).alias("_spent")
        )
        known += LEVEL
    last = (
        slim.alias("d")
        .join(dimension(state).alias("s"), _same_source("d", "s"))
        .filter(F.shiftright("_hash", HASH_BITS - known) == F.col("_prefix"))
        .groupBy("s._src", "s.budget", "s._spent", "_hash")
        .agg(F.sum("size").alias("_size"))
    )
    run = F.sum("_size").over(W.partitionBy("_src").orderBy("_hash")) + F.col("_spent")
    # A hash is taken while that brings the sum nearer to the budget.
    return (
        last.withColumn("_after", run)
        .filter((F.col("_after") <= F.col("budget")) | (F.col("_after") - F.col("budget") < F.col("budget") - (F.col("_after") - F.col("_size"))))
        .groupBy("_src")
        .agg(F.max("_hash").alias("_last"))
        .join(state.select(F.col("_src").alias("_s"), "_prefix"), F.col("_src").eqNullSafe(F.col("_s")), "full")
        .select(
            F.coalesce("_src", "_s").alias("_src"),
            F.coalesce(F.col("_last") + 1, F.shiftleft("_prefix", HASH_BITS - known)).alias("below"),
        )
    )


def _hashed(docs: DataFrame, seed: str) -> DataFrame:
    return docs.withColumn("_src", F.col("source")).withColumn("_hash", doc_hash(F.col("doc_id"), F.col("text"), seed))


def settle(slim: DataFrame, weights=rotating_weights, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """For each source: source_size, target, _whole (copies of all its documents) and below (the
    hash under which a document gives one copy more). `slim` has _src, _hash and size."""
    spark = slim.sparkSession
    plan = targets(weights(slim.groupBy("_src").agg(F.sum("size").alias("source_size"))), max_repeat)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("_whole", F.least(F.floor(ratio), F.lit(max_repeat)).cast("long")).withColumn(
        "budget", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    path = shared_folder(spark, "mix-plan")
    plan.write.parquet(path)
    plan = spark.read.parquet(path)
    below = thresholds(slim, plan.select("_src", "budget"))
    settled = plan.alias("p").join(below.alias("b"), _same_source("p", "b"), "left").select(
        "p._src", "p.source_size", "p.target", "p._whole", F.coalesce("b.below", F.lit(0)).alias("below")
    )
    path = shared_folder(spark, "mix-plan")
    settled.write.parquet(path)
    return spark.read.parquet(path)


def with_copies(hashed: DataFrame, settled: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """`hashed` (with _src and _hash) and source_size, target, copies."""
    extra = (F.col("_hash") < F.col("below")) & (F.col("_whole") < max_repeat)
    copies = F.col("_whole") + F.when(extra, 1).otherwise(0)
    joined = hashed.alias("d").join(dimension(settled).alias("s"), _same_source("d", "s"))
    return joined.select("d.*", "s.source_size", "s.target", copies.alias("copies")).drop("_src", "_hash")


def _slim(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, _src, _hash and size, written once, so that no histogram level reads texts again."""
    path = shared_folder(docs.sparkSession, "mix")
    sized = _hashed(docs.select("doc_id", "text", "source"), seed)
    sized.select("doc_id", "_src", "_hash", tx.n_words(F.col("text")).alias("size")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def mix(docs: DataFrame, weights=rotating_weights, max_repeat: int = MAX_REPEAT, seed: str = "") -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (= copies * size) of every row."""
    slim = _slim(docs, seed)
    settled = settle(slim, weights, max_repeat)
    return with_copies(slim, settled, max_repeat).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_rows(docs: DataFrame, weights=rotating_weights, max_repeat: int = MAX_REPEAT, seed: str = "") -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; rows without a word are left out.

    Texts are read twice and not shuffled.
    """
    settled = settle(_slim(docs, seed), weights, max_repeat)
    rows = docs.filter(F.col("text").rlike(tx.WORD)).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    keyed = rows.select(
        "_row",
        F.col("_row.source").alias("_src"),
        doc_hash(F.col("_row.doc_id"), F.col("_row.text"), seed).alias("_hash"),
    )
    taken = with_copies(keyed, settled, max_repeat).filter(F.col("copies") > 0)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def op4_source_mix(spark, sf_dir: str) -> DataFrame:
    mixed = mix(tx.documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
with d as (
  select doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || chr(31) || coalesce(text, '')), 1, 12)
              as bigint) as h
  from documents),
s as (
  select source, sum(size) as source_size,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from d group by source),
ranked as (
  select *, row_number() over o as k, sum(source_size) over () as total,
         coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0) as capped,
         sum(weight) over (o rows between current row and unbounded following) as rest
  from s window o as (order by cast(3 * source_size as double) / weight, source nulls first)),
levels as (select *, cast(total - capped as double) / cast(rest as double) as lvl from ranked),
free as (
  select min(k) as k0, arg_min(lvl, k) as lvl0 from levels where cast(3 * source_size as double) > lvl * weight),
t as (
  select source, source_size,
         case when k0 is null or k < k0 then cast(3 * source_size as double) else lvl0 * weight end as target
  from levels cross join free),
b as (
  select *, case when source_size > 0 then least(floor(target / source_size), 3) else 0 end as whole from t),
g as (select source, h, sum(size) as size from d group by source, h),
r as (
  select g.source, g.h, g.size, b.target - b.whole * b.source_size as budget, b.whole,
         sum(g.size) over (partition by g.source order by g.h) as after
  from g join b on g.source is not distinct from b.source),
extra as (
  select source, h from r
  where whole < 3 and (after <= budget or after - budget < budget - (after - size)))
select d.doc_id, cast(d.size as bigint) as size, cast(b.source_size as bigint) as source_size, b.target as target,
       cast(d.size * (b.whole + case when e.h is null then 0 else 1 end) as bigint) as taken
from d join b on d.source is not distinct from b.source
left join extra e on d.source is not distinct from e.source and d.h = e.h
"""
