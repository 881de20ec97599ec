"""Time the oracle SQL of every registered query in DuckDB (single-node yardstick).

Usage: python tools/duck_bench.py /root/testdata/sf0.1
"""
import sys, time, json, os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import duckdb
from lodgeflow.oracle import queries_sql
d = sys.argv[1]
con = duckdb.connect()
for t in "region nation customer supplier part orders lineitem".split():
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
out = {}
for name, sql in queries_sql().items():
    t = time.perf_counter(); con.execute(sql).fetchall(); out[name] = round(time.perf_counter() - t, 3)
print(json.dumps({"total": round(sum(out.values()), 3), "queries": out}))
