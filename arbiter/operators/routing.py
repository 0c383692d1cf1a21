"""Routing and subscription fan-out between clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import parse_group_table, subscription_message
from .asof import as_of
from .joins import small

INTERNAL, EXTERNAL = "internal_groups", "external_groups"


def lookup_cluster(updates: DataFrame, assignments: DataFrame, own: str, group: str = "group_id") -> DataFrame:
    """Owning cluster of each update's group (left lookup; unknown groups stay at home)."""
    a = small(assignments.select(F.col("group_name").alias(group), F.col("cluster").alias("_owner")))
    return (updates.join(a, group, "left")
            .withColumn("cluster_id", F.coalesce(F.col("_owner"), F.lit(own))).drop("_owner"))


def route(updates: DataFrame, assignments: DataFrame, own: str, update: str = "update",
          group: str = "group_id") -> DataFrame:
    """Enrich with the owner and pick the topic; the message is the routed update JSON."""
    return _addressed(lookup_cluster(updates, assignments, own, group), own, update, group)


def _addressed(r: DataFrame, own: str, update: str, group: str) -> DataFrame:
    msg = F.to_json(F.struct(F.col(update).alias("update"), F.col(group).alias("group_id"),
                             F.col("cluster_id").alias("cluster_id")))
    return (r.withColumn("topic", F.when(F.col("cluster_id") == own, F.lit(INTERNAL)).otherwise(F.lit(EXTERNAL)))
            .withColumn("message", msg))


def route_as_of(updates: DataFrame, changes: DataFrame, own: str, at: str, since: str, tie: str, update: str = "update",
                group: str = "group_id") -> DataFrame:
    """J4 + T6 + E8: as ``route``, but by the owner that the group table named at each update's own time. ``changes``:
    (group_name, cluster, since, tie), one row per assignment that a message brought."""
    table = changes.select(F.col("group_name").alias(group), F.col("cluster").alias("_owner"), since, tie)
    r = as_of(updates, table, group, at, since, ["_owner"], tie).withColumn("cluster_id", F.coalesce("_owner", F.lit(own))).drop("_owner")
    return _addressed(r, own, update, group)


def latest_assignment(msgs: DataFrame, key: str, value: str, offset: str) -> DataFrame:
    """Latest value per key by offset (last writer wins)."""
    return msgs.groupBy(key).agg(F.max_by(value, offset).alias(value), F.max(offset).alias(offset))


def group_table(msgs: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """``group_table`` messages -> the latest cluster per group, (group_name, cluster, offset). A message adds
    or replaces the groups it names and leaves the others; of one message the last entry of a group counts."""
    parsed = msgs.select(offset, F.posexplode(parse_group_table(value)["GroupAssignment"]).alias("_i", "_a"))
    latest = parsed.where(F.col("_a.GroupName").isNotNull()).groupBy(F.col("_a.GroupName").alias("group_name")).agg(
        F.max_by("_a.Cluster", F.struct(offset, "_i")).alias("cluster"), F.max(offset).alias("offset"))
    return latest


def latest_rules(msgs: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """E6 source: the rule document of the latest message that carries one, (rules, offset); no row without any."""
    rules = msgs.select(offset, parse_group_table(value)["GroupingRules"].alias("rules")).where("rules is not null")
    return rules.agg(F.max_by("rules", offset).alias("rules"), F.max(offset).alias("offset")).where("offset is not null")


def first_per_key(rows: DataFrame, key: str, value: str, offset: str) -> DataFrame:
    """First value per key by offset."""
    return rows.groupBy(key).agg(F.min_by(value, offset).alias(value), F.min(offset).alias(offset))


def subscriber_pairs(pairs: DataFrame) -> DataFrame:
    """T5 registry as flat distinct ``(group_id, cluster_id)`` pairs (partial distinct map-side)."""
    return pairs.select("group_id", "cluster_id").distinct()


def subscriber_sets(pairs: DataFrame) -> DataFrame:
    """Subscriber set per group (bounded by the number of clusters)."""
    return (subscriber_pairs(pairs).groupBy("group_id")
            .agg(F.array_sort(F.collect_list("cluster_id")).alias("subscribers")))


def merge_subscribers(registry: DataFrame, new_pairs: DataFrame) -> DataFrame:
    """Registry := registry U new subscriptions (set union per group)."""
    return subscriber_sets(registry.select("group_id", "cluster_id").unionByName(new_pairs.select("group_id", "cluster_id")))


def fan_out(decisions: DataFrame, registry_pairs: DataFrame, own: str, group: str = "group_id") -> DataFrame:
    """J2 + E19: one copy of each decision message per subscribing cluster other than ``own``.

    The registry is small (groups x clusters) and broadcast behind a size check; decisions of
    unknown groups produce nothing (inner join).
    """
    reg = small(registry_pairs.where(F.col("cluster_id") != own).select(group, "cluster_id").distinct())
    return decisions.join(reg, group)


def subscribe_to_owners(external: DataFrame, own: str, group: str = "group_id", offset: str = "offset") -> DataFrame:
    """A13 + E14: for every external group, one ``group;own`` subscription to its owner."""
    first = first_per_key(external, group, "cluster_id", offset)
    return first.select(group, F.col("cluster_id").alias("dest_cluster"),
                        subscription_message(F.col(group), F.lit(own)).alias("message"))


def first_route(routes: DataFrame, key: str, address: str, order: str) -> DataFrame:
    """First route per key in table order."""
    return routes.groupBy(key).agg(F.min_by(address, order).alias(address))


def liveness(beats: DataFrame, last_batch: int, cluster: str = "cluster_id", batch: str = "epoch",
             max_silence: int = 1) -> DataFrame:
    """Heartbeat view per cluster: beats, last batch, largest gap, alive flag.

    Gaps come from a bucketed per-cluster ordinal and look-back (no window holds a whole
    cluster's history), then one grouped aggregate.
    """
    from .ordinal import lag_global, with_ordinal
    b = with_ordinal(beats.select(cluster, batch).distinct(), [batch], partition_by=[cluster], name="_o")
    g = lag_global(b, "_o", batch, "_prev", partition_by=[cluster])
    return (g.groupBy(cluster)
            .agg(F.count(F.lit(1)).alias("n_beats"), F.max(batch).alias("last_batch"),
                 F.coalesce(F.max(F.col(batch) - F.col("_prev")), F.lit(0)).cast("bigint").alias("max_gap"))
            .withColumn("alive", F.col("last_batch") >= F.lit(int(last_batch) - max_silence)))
