"""Judge every row of many months at once: rules, reversal pairs, copies, near-duplicates.

Ordinary trips take one exchange and one sort. Rows are hashed by trip identity; every
window below partitions by a prefix of one sort order, so nothing is exchanged or sorted again:

    hash of identity, month, identity, fare of the original | other amounts | side | trip_id
    `--------------- near-duplicates ---------------------'
    `------------- signature (totals per side) ----------------------------'
    `------------- one side of a signature (ranks) -------------------------------'

A trip identity that holds a large share of all rows (bad clocks, NULL identities, a file pasted
many times) would make one task of that. Such identities are found by counting a sample and take
the counted route: copies collapse on the map side, and ranks are prefix sums over MD5 slots.
Both routes give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.functions.contract import FLAGS, REASONS, TRIPS
from monthlake.operators.rules import (
    IDENTITY,
    Limits,
    batch_rules,
    failed_codes,
    is_negative,
    reason_columns,
    row_flags,
)
from monthlake.operators.skew import (
    DEFAULT_POLICY,
    HotPolicy,
    group_total,
    hot_keys,
    key_hash,
    repeat_rows,
    slot_of,
    split_hot,
)

GROUP = ("source_month", *IDENTITY)
SIGNED = {f"_orig_{m}": m for m in TRIPS.money}  # the original's amounts, fare first
SIGNATURE = (*GROUP, *SIGNED)
NEAR = (*GROUP, "_orig_fare_amount")  # a kept row is never negative: its own fare


def classify(
    typed: DataFrame,
    *,
    limits: Limits = Limits(),
    policy: HotPolicy | None = DEFAULT_POLICY,
    co_located: bool = False,
) -> DataFrame:
    """`typed` holds the contract's columns plus source_month and processed_at, before fills.

    Returns core columns, flags and reasons. `policy=None` skips the look for hot identities.
    `co_located`: the rows come from a table bucketed by identity (`store_by_identity`), and are judged where they lie.
    """
    hot = hot_keys(typed, IDENTITY, policy) if policy else None
    if hot is None or hot.isEmpty():
        return _by_windows(typed, limits, co_located)
    ordinary, crowded = split_hot(typed, IDENTITY, hot)
    return _by_windows(ordinary, limits, co_located).unionByName(_by_counts(crowded, limits))


def _signed(trips: DataFrame) -> DataFrame:
    trips = trips.withColumn("_negative", is_negative())
    amounts = {
        alias: F.when(F.col("_negative"), -F.col(m)).otherwise(F.col(m))
        for alias, m in SIGNED.items()
    }
    return trips.withColumns(amounts)


def _result(judged: DataFrame) -> DataFrame:
    core = [name for name, _ in TRIPS.core_schema()]
    return judged.select(*core, *FLAGS, *REASONS)


def store_by_identity(typed: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write typed rows as a table bucketed and sorted by trip identity, one file a bucket.

    One exchange here; rows that are judged again under other limits, or by other rules, need none. `buckets` is chosen
    so that one fits a task: some 128 MB each.
    """
    (
        typed.repartition(buckets, *IDENTITY)
        .write.mode("overwrite")
        .bucketBy(buckets, *IDENTITY)
        .sortBy(*IDENTITY)
        .option("path", path)
        .saveAsTable(table)
    )


def _by_windows(typed: DataFrame, limits: Limits, co_located: bool = False) -> DataFrame:
    # Exchange first, then fingerprint and fill: the 32-byte id is not shuffled. The month stays
    # out of the hash: in a single-month job it is a constant, which the optimizer drops from the
    # windows but not from the exchange, and they would no longer fit together.
    rows = _signed(TRIPS.identified(typed if co_located else typed.repartition(*IDENTITY)))
    # A hash leads the sort order: eight bytes that tell almost all identities apart, where the month tells few.
    rows = rows.withColumn("_key", key_hash(IDENTITY))
    side = Window.partitionBy("_key", *SIGNATURE, "_negative").orderBy("trip_id")
    both = Window.partitionBy("_key", *SIGNATURE)
    ranked = (
        rows.withColumns(
            {"_rank": F.row_number().over(side), "_first_copy": F.rank().over(side)}
        )
        # The highest rank of a side is its size. Reading _rank also keeps the two windows in this
        # order, so the second reuses the sort of the first.
        .withColumns(
            {
                "_n_neg": F.max(F.when(F.col("_negative"), F.col("_rank"))).over(both),
                "_n_pos": F.max(F.when(~F.col("_negative"), F.col("_rank"))).over(both),
            }
        )
        .withColumn("_pairs", F.least(*[F.coalesce(n, F.lit(0)) for n in ("_n_neg", "_n_pos")]))
    )
    rules = batch_rules(F.col("_negative"), F.col("_rank") <= F.col("_pairs"), limits)
    passes = F.col("_failed") == ""
    # Copies rank side by side. The first copy that is not half of a pair is the one to keep.
    kept_copy = F.col("_rank") == F.greatest("_first_copy", F.col("_pairs") + 1)
    judged = (
        ranked.withColumn("_failed", failed_codes(rules))
        .withColumns(reason_columns("_failed", passes & ~kept_copy))
        .withColumn("_kept", F.col("reject_reason").isNull())
    )
    twins = F.count_if("_kept").over(Window.partitionBy("_key", *NEAR))
    flags = {**row_flags(limits), "is_near_duplicate": F.col("_kept") & (twins > 1)}
    return _result(judged.withColumns(flags))


def _by_counts(typed: DataFrame, limits: Limits) -> DataFrame:
    """The same verdicts from counts, for identities of any size."""
    trips = TRIPS.identified(typed)
    copies = (
        _signed(trips.groupBy(*trips.columns).agg(F.count(F.lit(1)).alias("_copies")))
        .withColumn("_sig", F.struct(*SIGNATURE))
        .withColumn("_near", F.struct(*NEAR))
        .withColumn("_slot", slot_of("trip_id"))
    )
    # Prefix sums over slots: trip_id order is slot order first, so a slot's offset is the count
    # of everything in earlier slots. At most 65,536 rows per side reach one window.
    earlier = Window.partitionBy("_sig", "_negative").orderBy("_slot")
    per_slot = copies.groupBy("_sig", "_negative", "_slot").agg(F.sum("_copies").alias("_n"))
    both = Window.partitionBy("_sig")
    offsets = per_slot.select(
        "_sig",
        "_negative",
        "_slot",
        (F.sum("_n").over(earlier) - F.col("_n")).alias("_before"),
        F.least(
            F.sum(F.when(F.col("_negative"), F.col("_n")).otherwise(0)).over(both),
            F.sum(F.when(F.col("_negative"), 0).otherwise(F.col("_n"))).over(both),
        ).alias("_pairs"),
    )
    in_slot = Window.partitionBy("_sig", "_negative", "_slot").orderBy("trip_id")
    ranked = copies.join(offsets, ["_sig", "_negative", "_slot"]).withColumn(
        "_start", F.col("_before") + F.sum("_copies").over(in_slot) - F.col("_copies")
    )
    paired = F.greatest(F.lit(0), F.least("_copies", F.col("_pairs") - F.col("_start")))
    counted = ranked.withColumn("_n_paired", paired).withColumn(
        "_n_loose", F.col("_copies") - F.col("_n_paired")
    )
    loose_failed = failed_codes(batch_rules(F.col("_negative"), F.lit(False), limits))
    counted = counted.withColumn("_clean", loose_failed == "")
    zero = F.lit(0).cast("long")
    fates = F.array(
        *[
            F.struct(F.lit(p).alias("paired"), F.lit(d).alias("duplicate"), n.cast("long").alias("n"))
            for p, d, n in (
                (True, False, F.col("_n_paired")),
                (
                    False,
                    False,
                    F.when(F.col("_clean"), F.least(F.col("_n_loose"), F.lit(1))).otherwise(
                        F.col("_n_loose")
                    ),
                ),
                (
                    False,
                    True,
                    F.when(F.col("_clean"), F.greatest(zero, F.col("_n_loose") - 1)).otherwise(
                        zero
                    ),
                ),
            )
        ]
    )
    rules = batch_rules(F.col("_negative"), F.col("_fate.paired"), limits)
    judged = (
        counted.withColumn("_fate", F.explode(F.filter(fates, lambda f: f["n"] > 0)))
        .withColumn("_failed", failed_codes(rules))
        .withColumns(reason_columns("_failed", F.col("_fate.duplicate")))
        .withColumn("_kept", F.col("reject_reason").isNull())
        .withColumn("_times", F.col("_fate.n"))
    )
    near = group_total(judged, "_near", "_slot", F.col("_kept").cast("long"), "_twins")
    flags = {**row_flags(limits), "is_near_duplicate": F.col("_kept") & F.col("_twins").isNotNull()}
    core = [name for name, _ in TRIPS.core_schema()]
    flat = near.withColumns(flags).select(*core, *FLAGS, *REASONS, "_times")
    return _result(repeat_rows(flat, "_times", "trip_id"))
