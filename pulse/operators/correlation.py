"""Matching events with known triggers and with items close in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.operators.ranking import top_k
from pulse.session import stored


def merge_events(shift_rows: DataFrame, spike_rows: DataFrame) -> DataFrame:
    """One event per date: a sentiment shift before a volume spike before an
    engagement spike."""

    def pick(df: DataFrame, flag: str, prio: int, kind: str, z: str, direction) -> DataFrame:
        return df.where(flag).select(
            F.to_date("bucket").alias("event_date"),
            F.struct(
                F.lit(prio).alias("prio"), F.col("bucket"), F.lit(kind).alias("event_type"), F.col(z).alias("zscore"),
                direction.alias("direction"),
            ).alias("e"),
        )

    every = (
        pick(shift_rows, "is_shift", 1, "sentiment_shift", "roll_zscore", F.col("shift_dir"))
        .union(pick(spike_rows, "is_spike", 2, "volume_spike", "vol_zscore", F.lit("")))
        .union(pick(spike_rows, "is_eng_spike", 3, "engagement_spike", "eng_zscore", F.lit("")))
    )
    first = every.groupBy("event_date").agg(F.min("e").alias("e"))
    return first.select("event_date", "e.event_type", F.round("e.zscore", 3).alias("zscore"), "e.direction")


def nearest_event(
    events: DataFrame, triggers: DataFrame, max_days: int = 7, on: str = "event_date"
) -> DataFrame:
    """The trigger nearest to each event's date, the earlier one on a tie,
    none beyond ``max_days``.

    Triggers are spread over the days they can reach and reduced to the best
    one per day; events then need a plain join on the day. No pairs of events
    and triggers are formed.
    """
    reach = triggers.select(
        "trigger_date", "description", F.explode(F.sequence(F.lit(-max_days), F.lit(max_days))).alias("off")
    )
    best = reach.groupBy(F.date_add("trigger_date", F.col("off")).alias(on)).agg(
        F.min(F.struct(F.abs("off").alias("days_apart"), "trigger_date", "description")).alias("t")
    )
    return events.join(best, on, "left").select(*[c for c in events.columns], "t.trigger_date", "t.description", "t.days_apart")


# Items of one time bin that a task should meet at most, as far as events allow.
BIN_ROWS = 200_000


def within_interval(
    events: DataFrame,
    items: DataFrame,
    hours: int = 48,
    k: int = 5,
    event_ts: str = "event_ts",
    item_ts: str = "ts",
    item_id: str = "item_id",
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """The ``k`` newest items within ``hours`` of each event, ranked.

    Time is cut into bins as wide as the interval, so an event looks into its
    own bin and the two beside it, and the join is an equi-join on the bin. A
    bin with more than ``bin_rows`` items is split by a hash of the item, and
    the events that look into it are repeated for every split; only those bins
    cost more. Only ``k`` rows per event leave a task. Every event has a list
    of its own: equal event rows are matched once and repeated at the end.
    """
    width = hours * 3_600_000_000

    def bin_of(c: str) -> Column:
        t = F.unix_micros(F.col(c).cast("timestamp"))
        return ((t - F.pmod(t, F.lit(width))) / width).cast("long")

    binned = items.withColumn("_bin", bin_of(item_ts))
    sizes = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bin_rows)
    hot = stored(sizes.select("_bin", F.ceil(F.col("_n") / bin_rows).cast("int").alias("_splits")), "hot-bins")
    split = F.coalesce(F.pmod(F.xxhash64(item_id), F.col("_splits")), F.lit(0)).cast("int")
    binned = binned.join(hot, "_bin", "left").withColumn("_split", split).drop("_splits")

    keys = events.columns
    alike = events.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    spread = alike.withColumn("_bin", F.explode(F.array(*[bin_of(event_ts) + d for d in (-1, 0, 1)]))).join(hot, "_bin", "left")
    spread = spread.withColumn("_split", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1))).drop("_splits")
    near = binned.join(spread, ["_bin", "_split"])
    span = F.expr(f"INTERVAL {hours} HOURS")
    near = near.where(F.col(item_ts).between(F.col(event_ts) - span, F.col(event_ts) + span))
    best = top_k(near, [F.desc(item_ts), F.col(item_id)], k, keys)
    return best.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*items.columns, *keys)


def hypotheses(events: DataFrame) -> DataFrame:
    """A sentence per event that names its trigger, if there is one."""
    day = F.col("event_date").cast("string")
    named = F.format_string(
        "Hypothesis: the %s on %s likely correlates with '%s' (%s).",
        F.col("event_type"), day, F.col("description"), F.col("trigger_date").cast("string"),
    )
    bare = F.format_string(
        "Hypothesis: the %s on %s has no known trigger nearby.", F.col("event_type"), day
    )
    return events.withColumn("hypothesis", F.when(F.col("trigger_date").isNotNull(), named).otherwise(bare))


def correlate(events: DataFrame, triggers: DataFrame, headlines: DataFrame, max_days: int = 7, hours: int = 48, k: int = 5) -> DataFrame:
    """Events with nearest trigger, newest headlines nearby, hypothesis."""
    dated = stored(events.withColumn("event_ts", F.col("event_date").cast("timestamp")))
    found = within_interval(dated.select("event_ts"), headlines, hours, k)
    heads = found.groupBy("event_ts").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.unix_micros("ts")).alias("neg"), "item_id", "title"))),
            lambda h: h["title"],
        ).alias("headlines")
    )
    out = hypotheses(nearest_event(dated, triggers, max_days)).join(heads, "event_ts", "left").drop("event_ts")
    return out.withColumn("headlines", F.coalesce("headlines", F.array().cast("array<string>")))
