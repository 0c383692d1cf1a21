"""Compare Spark result types with DuckDB oracle types for every registered query."""

import sys

import duckdb

sys.path.insert(0, ".")
from arbiter.adapters import TABLES  # noqa: E402
from arbiter.plans.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from arbiter.session import get_spark  # noqa: E402

MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN"}

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = get_spark()
con = duckdb.connect()
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
bad = 0
for name, fn in QUERIES.items():
    if name not in ORACLE_SQL:
        continue
    sdf = fn(spark, sf)
    s = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE_SQL[name]}").fetchall()}
    diffs = [(c, s[c], d.get(c)) for c in s if MAP.get(s[c], s[c].upper()) != d.get(c)]
    if diffs or set(s) != set(d):
        bad += 1
        print(name, diffs, set(s) ^ set(d))
print("type mismatches:", bad)
