"""Message parsing and formatting.

Everything here returns Columns or does a projection; nothing shuffles. Malformed input never
raises: rows that fail to parse are split off with a reason (dead letters) instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import COST_LIMIT

TAB = "\t"
# The message fields, and the cost size from which a message is refused.
UPDATE_SCHEMA = "update STRING, group_id STRING, cluster_id STRING"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- E1 / E20: routed update -> (group, decision, score, 1) or a reject -------------------

def update_struct(value: str | Column) -> Column:
    """The message as a struct; text that is not a JSON object lands in ``_corrupt_record``."""
    return F.from_json(F.trim(_c(value)), UPDATE_SCHEMA + ", _corrupt_record STRING",
                       {"columnNameOfCorruptRecord": "_corrupt_record"})


def parse_update_columns(value: str | Column) -> dict[str, Column]:
    """Columns of a parsed message; ``value`` is the struct made by :func:`update_struct`."""
    js = _c(value)
    parts = F.split(js["update"], TAB)
    cost = F.get(parts, 1).try_cast("double")
    reason = (F.when(js["_corrupt_record"].isNotNull(), F.lit("not_json"))
              .when(js["group_id"].isNull(), F.lit("missing_group"))
              .when(js["update"].isNull(), F.lit("missing_update"))
              .when(F.size(parts) < 2, F.lit("missing_cost"))
              .when(cost.isNull(), F.lit("bad_cost"))
              .when(cost.isin(float("inf"), float("-inf")) | F.isnan(cost), F.lit("non_finite_cost"))
              .when(F.abs(cost) >= COST_LIMIT, F.lit("cost_out_of_range")))
    return {
        "group_id": js["group_id"],
        "cluster_id": js["cluster_id"],
        "decision": F.get(parts, 0),
        "score": F.lit(0.0) - cost,
        "reason": reason,
    }


def parse_updates(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split update messages into parsed rows and dead letters.

    parsed: ``keep + (group_id, decision, score, cnt)`` with ``score = 0 - cost`` and ``cnt = 1.0``
    rejects: ``keep + (value, reason)``

    Each message is parsed once: the struct comes out of a generator (one row per message), below
    which the filter on its fields can't be pushed.
    """
    once = df.select(*keep, F.col(value).alias("_value"), F.explode(F.array(update_struct(value))).alias("_js"))
    cols = parse_update_columns("_js")
    staged = once.select(*keep, "_value", *[c.alias(f"_{k}") for k, c in cols.items()])
    parsed = staged.where(F.col("_reason").isNull()).select(
        *keep, F.col("_group_id").alias("group_id"), F.col("_decision").alias("decision"),
        F.col("_score").alias("score"), F.lit(1.0).alias("cnt"))
    rejects = staged.where(F.col("_reason").isNotNull()).select(
        *keep, F.col("_value").alias("value"), F.col("_reason").alias("reason"))
    return parsed, rejects


# ---- E2 / E3 / E4 / E11: payload features -------------------------------------------------

def split_features(payload: str | Column) -> Column:
    """TAB payload -> array of features (trailing empty fields are kept: fixed width)."""
    return F.split(_c(payload), TAB, -1)


def default_group(rule_group: str | Column, features: str | Column, mode: str = "asn",
                  precedence: str = "rules") -> Column:
    """E3 (``mode='asn'``: feature 4) / E4 (``mode='null'``: the string "null").

    ``precedence='rules'``: a matching rule wins over the default (the UCB player);
    ``precedence='default'``: the default wins whenever present (the epsilon-greedy player
    assigns the ASN after evaluating the rules).
    """
    fallback = F.get(_c(features), 4) if mode == "asn" else F.lit("null")
    if precedence == "default":
        return F.coalesce(fallback, _c(rule_group))
    return F.coalesce(_c(rule_group), fallback)


def candidates(features: str | Column, first: int = 15) -> Column:
    """Offered options = features from position ``first`` (0-based) on."""
    f = _c(features)
    return F.slice(f, first + 1, F.greatest(F.size(f) - first, F.lit(0)))


# ---- E7: label projection -----------------------------------------------------------------

def project_labels(payload: str | Column, all_labels: Sequence[str], kept: Sequence[str]) -> Column:
    """Keep the configured labels of a positional TAB payload and re-join them by TAB. Labels beyond a short payload's end are
    empty, so the later ones keep their places; a null payload gives null."""
    idx = [list(all_labels).index(k) for k in kept]  # positions resolved once, on the driver
    parts = F.split(_c(payload), TAB, -1)
    kept_parts = F.transform(F.array(*[F.lit(i) for i in idx]), lambda i: F.get(parts, i))
    return F.when(_c(payload).isNotNull(), F.array_join(kept_parts, TAB, ""))


# ---- E12 / E13 / E14: message assembly and parsing ----------------------------------------

def tsv(*cols: str | Column) -> Column:
    return F.concat_ws(TAB, *[_c(c) for c in cols])


def decision_message(group: str | Column, payload: str | Column, origin: str) -> Column:
    """E13 format: ``group;payload;From: origin``."""
    return F.concat_ws(";", _c(group), _c(payload), F.lit(f"From: {origin}"))


def parse_decision_message(value: str | Column) -> dict[str, Column]:
    """E13 parse: group and payload are the first two ``;`` fields."""
    parts = F.split(_c(value), ";", -1)
    return {"group_id": F.get(parts, 0), "payload": F.get(parts, 1)}


def subscription_message(group: str | Column, cluster: str | Column) -> Column:
    """E14 format: ``group;cluster``."""
    return F.concat_ws(";", _c(group), _c(cluster))


def parse_subscription(value: str | Column) -> dict[str, Column]:
    parts = F.split(_c(value), ";", -1)
    return {"group_id": F.get(parts, 0), "cluster_id": F.get(parts, 1)}


def eg_payload(best: str | Column, others: str | Column, epsilon: float) -> Column:
    """Epsilon-greedy payload ``{"random":[...],"best":"...","epsilon":x}`` (fixed key order)."""
    return F.to_json(F.struct(_c(others).alias("random"), _c(best).alias("best"), F.lit(float(epsilon)).alias("epsilon")))


EG_SCHEMA = "random ARRAY<STRING>, best STRING, epsilon DOUBLE"


def parse_eg_payload(payload: str | Column) -> Column:
    """Unpack the epsilon-greedy JSON payload to a struct (epsilon, best, random)."""
    return F.from_json(_c(payload), EG_SCHEMA)


# ---- E9 / E10: trace lines ----------------------------------------------------------------

TRACE_MAP = "DecisionMap"
TRACE_LOAD = "LoadMap"


def parse_trace_line(line: str | Column) -> dict[str, Column]:
    """``ts⇥f1..f14⇥DecisionMap name,cost⇥...LoadMap name,thr;factor;...⇥...``.

    Returns the timestamp (ms), the feature array, the decision -> cost map, and the
    decision -> load-curve map (array of (threshold, factor), thresholds ascending as written).
    Repeated names keep the last entry (session mapKeyDedupPolicy=LAST_WIN).
    """
    ln = _c(line)
    head = F.split(ln, TRACE_MAP, 2)
    rest = F.split(F.get(head, 1), TRACE_LOAD, 2)
    feats = F.split(F.regexp_replace(F.get(head, 0), "\t$", ""), TAB, -1)
    dec_items = F.filter(F.split(F.regexp_replace(F.get(rest, 0), "\t$", ""), TAB, -1), lambda s: s != "")
    dmap = F.map_from_entries(F.transform(dec_items, lambda s: F.struct(
        F.get(F.split(s, ",", 2), 0).alias("key"),
        F.get(F.split(s, ",", 2), 1).try_cast("double").alias("value"))))
    load_items = F.filter(F.split(F.regexp_replace(F.get(rest, 1), "\t$", ""), TAB, -1), lambda s: s != "")

    def curve(item: Column) -> Column:
        nums = F.split(F.get(F.split(item, ",", 2), 1), ";", -1)
        thr = F.filter(nums, lambda x, i: i % 2 == 0)
        fac = F.filter(nums, lambda x, i: i % 2 == 1)
        return F.transform(F.arrays_zip(thr.alias("t"), fac.alias("f")), lambda p: F.struct(
            p["t"].try_cast("double").alias("threshold"), p["f"].try_cast("double").alias("factor")))

    lmap = F.map_from_entries(F.transform(load_items, lambda s: F.struct(
        F.get(F.split(s, ",", 2), 0).alias("key"), curve(s).alias("value"))))
    return {"ts_ms": F.get(feats, 0).try_cast("bigint"), "features": feats,
            "decision_map": dmap, "load_map": lmap}


def second_offset(ts_ms: str | Column, start_ms: str | Column) -> Column:
    """Ms -> s floor, offset from the trace start."""
    return F.floor(_c(ts_ms) / 1000) - F.floor(_c(start_ms) / 1000)


def minute_offset(sec: str | Column) -> Column:
    return F.floor(_c(sec) / 60)


# ---- E15: feature pairs --------------------------------------------------------------------

def feature_pairs(df: DataFrame, payload: str, n_management: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """Explode all but the trailing ``n_management`` labels into ``(feature_index, feature_value)``."""
    parts = F.split(F.col(payload), TAB, -1)
    body = F.slice(parts, 1, F.greatest(F.lit(0), F.size(parts) - n_management))
    return df.select(*keep, F.posexplode(body).alias("feature_index", "feature_value"))


# ---- E16: composite-key hash ----------------------------------------------------------------

def route_key(os: str | Column, isp: str | Column) -> Column:
    return F.md5(F.concat(_c(os), F.lit("&"), _c(isp)))


# ---- E17 / E18 / E19: predicates ---------------------------------------------------------------

def offered(decision_map: str | Column, decision: str | Column) -> Column:
    return F.coalesce(F.map_contains_key(_c(decision_map), _c(decision)), F.lit(False))


def succeeded(result: str | Column, body_len: str | Column | None = None, expected_len: int | None = None) -> Column:
    ok = _c(result) == 1
    if body_len is not None and expected_len is not None:
        ok = ok & (_c(body_len) == expected_len)
    return ok


def not_own(cluster: str | Column, own: str) -> Column:
    return _c(cluster) != F.lit(own)


# ---- group table messages ---------------------------------------------------------------------

# The two optional parts of a group table message; the rules stay JSON text of any depth.
GROUP_TABLE_SCHEMA = "GroupAssignment ARRAY<STRUCT<GroupName: STRING, Cluster: STRING>>, GroupingRules STRING"


def parse_group_table(value: str | Column) -> Column:
    """A group table message as a struct; a part that is absent (or a message that isn't JSON) is null."""
    return F.from_json(_c(value), GROUP_TABLE_SCHEMA)
