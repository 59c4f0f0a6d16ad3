"""Compare registered queries with their oracle SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return ("f", round(v, 9))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    return v if v is None or isinstance(v, str) else (type(v).__name__, str(v))


def duck(sf_dir: str):
    import duckdb

    from workload.inputs import TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name, fn, sql, sf_dir) -> str:
    """'' where both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    mine = sorted(df.columns)
    left = Counter(tuple(_value(r[c]) for c in mine) for r in df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != mine:
        return f"columns {mine} vs {sorted(names)}"
    order = [names.index(c) for c in mine]
    right = Counter(tuple(_value(r[i]) for i in order) for r in rel.fetchall())
    if left == right:
        return "" if left else "both empty"
    only_l, only_r = left - right, right - left
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows; columns {mine}\n   spark only {sum(only_l.values())}: "
        f"{list(only_l)[:2]}\n   duck only {sum(only_r.values())}: {list(only_r)[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from zonelens.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session("oracle-check")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0 = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, name, fn, oracles[name], sf_dir)
                kind = "ok" if not verdict else "DIFF"
            else:
                verdict, kind = f"{fn(spark, sf_dir).count()} rows", "rows"
        except Exception as err:  # show it and go on
            verdict, kind = str(err)[:1500], "ERROR"
        bad += kind in ("DIFF", "ERROR")
        print(f"{kind:5} {name} {time.time() - t0:.1f}s {verdict}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
