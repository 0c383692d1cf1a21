"""Rule-tree group assignment.

A rule document is a tree ``{"Field": i, "Table": [{"Key": k, "Rule": <node>}, ...]}`` whose
leaves are ``{"GroupName": g}``. It reads as nested ``if features[i] == k`` tests applied in
document order, so the **last** matching leaf wins; a node with ``Field`` ignores its own
``GroupName``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small

PATH_T = "array<struct<field:int,key:string>>"


def node_schema(depth: int) -> str:
    """Bounded-depth DDL schema of a rule node (JSON recursion unrolled ``depth`` levels)."""
    node = "struct<GroupName:string>"
    for _ in range(depth):
        node = f"struct<Field:string,GroupName:string,Table:array<struct<Key:string,Rule:{node}>>>"
    return node


def rule_depth(docs: DataFrame, doc: str = "rules") -> int:
    """Levels that the documents' rules may have: each one opens two braces outside strings (one scalar job)."""
    step = lambda acc, c: F.struct((acc["now"] + F.when(c == "{", 1).otherwise(-1)).alias("now"),
                                   F.greatest(acc["most"], acc["now"] + F.when(c == "{", 1).otherwise(0)).alias("most"))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    braces = F.filter(F.split(F.regexp_replace(doc, r'"(?:\\.|[^"\\])*+"|[^{}"]', ""), ""), lambda c: c != "")
    return ((docs.agg(F.max(F.aggregate(braces, start, step)["most"])).first()[0] or 0) + 1) // 2


def flatten_rules(docs: DataFrame, doc: str = "rules", doc_id: str = "doc_id", depth: int | None = None) -> DataFrame:
    """Rule documents -> one row per root-to-leaf path, in document order, however deep.

    ``depth`` (levels of tables) is taken from the documents unless given.

    Output ``doc_id, rule_order ARRAY<INT>, path ARRAY<STRUCT<field,key>>, group_name``;
    ``rule_order`` (the positions along the path) sorts the rules in document order.
    One chain of ``posexplode_outer`` steps (one per level): a leaf's missing table yields a
    single null row at the next level, so every leaf ends up as exactly one row.
    """
    depth = rule_depth(docs, doc) if depth is None else depth
    t = docs.select(doc_id, F.from_json(F.col(doc), node_schema(depth)).alias("n0"))
    for k in range(1, depth + 1):
        t = t.select("*", F.posexplode_outer(f"n{k - 1}.Table").alias(f"p{k}", f"e{k}")) \
             .withColumn(f"n{k}", F.col(f"e{k}.Rule")).drop(f"e{k}")
    # the leaf is the first node on the chain without a Field
    group = order = path = None
    for k in range(depth, -1, -1):
        n = F.col(f"n{k}")
        is_leaf = n.isNotNull() & (n["Field"].isNull() if k < depth else F.lit(True)) & n["GroupName"].isNotNull()
        if k > 0:
            prev_inner = F.lit(True)
            for j in range(k):
                prev_inner = prev_inner & F.col(f"n{j}")["Field"].isNotNull()
            is_leaf = is_leaf & prev_inner
        o = F.array(*[F.col(f"p{j}").cast("int") for j in range(1, k + 1)]) if k else F.array().cast("array<int>")
        pth = (F.array(*[F.struct(F.col(f"n{j - 1}")["Field"].cast("int").alias("field"),
                                  F.col(f"n{j - 1}")["Table"][F.col(f"p{j}")]["Key"].alias("key"))
                         for j in range(1, k + 1)]) if k else F.array().cast(PATH_T))
        g = n["GroupName"]
        group = F.when(is_leaf, g) if group is None else F.when(is_leaf, g).otherwise(group)
        order = F.when(is_leaf, o) if order is None else F.when(is_leaf, o).otherwise(order)
        path = F.when(is_leaf, pth) if path is None else F.when(is_leaf, pth).otherwise(path)
    out = t.select(doc_id, order.alias("rule_order"), path.cast(PATH_T).alias("path"), group.alias("group_name"))
    return out.where(F.col("group_name").isNotNull())


def _match(features: Column, path) -> Column:
    cond = F.lit(True)
    for field, key in path:
        cond = cond & F.coalesce(F.get(features, int(field)) == F.lit(key), F.lit(False))
    return cond


def rules_case(features: Column, rules: list[tuple[list[tuple[int, str]], str]]) -> Column:
    """Compile (path, group) rules, in document order, to one CASE expression: the first WHEN
    is the last rule, so the last matching rule wins. Pure projection, whole-stage codegen."""
    expr = None
    for path, group in reversed(rules):
        cond = _match(features, path)
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(F.lit(None).cast("string")) if expr is not None else F.lit(None).cast("string")


def assign_groups(df: DataFrame, features: str, rule_paths: DataFrame, out: str = "rule_group") -> DataFrame:
    """E5: add the rule group of each row (null when no rule matches; the rule latest in the document wins).

    Rules that test the same fields form one table from their keys to their latest (order, group), and a
    row joins each table once, by the values of those fields: one match at most, so rows neither
    multiply nor need a key. The plan grows with the distinct field sets (read to the driver), not with the rules.
    """
    rules = rule_paths.select(F.transform("path", lambda p: p["field"]).alias("_fields"),
                              F.transform("path", lambda p: p["key"]).alias("_keys"), "rule_order", "group_name")
    last = rules.groupBy("_fields", "_keys").agg(F.max(F.struct("rule_order", "group_name")).alias("_hit"))
    sets = sorted(tuple(r["_fields"]) for r in last.select("_fields").distinct().collect())
    hits = []
    for i, fields in enumerate(sets):
        same = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<int>")
        table = last.where(F.col("_fields") == same).select(F.col("_keys").alias(f"_k{i}"), F.col("_hit").alias(f"_h{i}"))
        parts = [F.get(F.col(features), f) for f in fields]
        key = F.array(*parts) if parts else F.array().cast("array<string>")
        for x in parts:
            key = F.when(x.isNotNull(), key)
        # rules without a test have one table row at most
        df = df.join(small(table) if fields else F.broadcast(table), key == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        hits.append(f"_h{i}")
    if not hits:
        return df.withColumn(out, F.lit(None).cast("string"))
    best = F.greatest(*hits) if len(hits) > 1 else F.col(hits[0])
    return df.withColumn(out, best["group_name"]).drop(*hits)
