"""Compare a registered query with its SQL twin, cell by cell."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'") if con.execute("select 1 from duckdb_settings() where name='TimeZone'").fetchall() else None
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, float) and v != v:
        return "NaN"
    return (type(v).__name__, v)


def compare(spark, con, query, sf_dir: str) -> tuple[bool, str]:
    df = query.run(spark, sf_dir)
    started = time.time()
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if query.sql is None:
        return True, f"rows={len(rows)} {took:.1f}s (no SQL twin)"
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    order_s = [df.columns.index(c) for c in sorted(df.columns)]
    order_d = [names.index(c) for c in sorted(names)]
    a = Counter(tuple(_norm(r[i]) for i in order_s) for r in rows)
    b = Counter(tuple(_norm(r[i]) for i in order_d) for r in want)
    if a != b:
        only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
        return False, (f"rows {len(rows)} vs {len(want)}; differing {sum((a - b).values())}\n   cols  {sorted(names)}\n"
                       f"   spark {only_a}\n   sql   {only_b}")
    types_s = [df.schema[c].dataType.simpleString() for c in sorted(df.columns)]
    types_d = [str(cur.description[i][1]) for i in order_d]
    pairs = {("int", "BIGINT"), ("bigint", "INTEGER")}
    odd = [f"{c}:{s}/{d}" for c, s, d in zip(sorted(names), types_s, types_d) if (s, d.upper()) in pairs or "HUGE" in d.upper()]
    note = " TYPES " + ",".join(odd) if odd else ""
    return True, f"rows={len(rows)} {took:.1f}s{' EMPTY' if not rows else ''}{note}"


def main(argv: list[str]) -> int:
    from tidemark.plans import MODULES, REGISTRY, load_all
    from tidemark.session import local_session

    import importlib

    sf = "0.01"
    picks = []
    for a in argv:
        if a.startswith("sf="):
            sf = a[3:]
        elif a.startswith("hot="):
            from tidemark.operators import windows
            windows.HOT_ROWS = int(a[4:])
        else:
            picks.append(a)
    for m in MODULES:
        try:
            importlib.import_module(f"tidemark.plans.{m}")
        except ModuleNotFoundError as e:
            print("missing", m, e)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name, q in REGISTRY.items():
        module = q.build.__module__.rsplit(".", 1)[-1]
        if picks and name not in picks and module not in picks:
            continue
        try:
            ok, note = compare(spark, con, q, sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
