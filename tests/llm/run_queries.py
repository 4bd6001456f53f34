"""python tests/llm/run_queries.py SF NAME...: run queries beside their SQL."""
import sys
import time

sys.path[:0] = [".", "tests"]
import oracle_util as ou  # noqa: E402
from eventide.llm.queries import ORACLES, QUERIES  # noqa: E402
from eventide.session import build_session  # noqa: E402


def compare(spark, name, sf, con=None):
    t = time.time()
    df = QUERIES[name](spark, sf)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    took = time.time() - t
    if name not in ORACLES:
        return {"name": name, "rows": len(rows), "s": round(took, 1), "first": dict(zip(cols, rows[0])) if rows else None}
    rel = (con or ou.duck(sf)).sql(ORACLES[name])
    want = ou.rows_of(rel.columns, rel.fetchall())
    got = ou.rows_of(cols, rows)
    same = sorted(cols) == sorted(rel.columns) and got == want
    return {"name": name, "rows": len(rows), "s": round(took, 1), "same": same,
            **({} if same else {"cols": [cols, rel.columns], "only": [sorted(set(got) - set(want), key=repr)[:3], sorted(set(want) - set(got), key=repr)[:3]]})}


if __name__ == "__main__":
    spark = build_session("local[8]", 8)
    for n in sys.argv[2:]:
        print(compare(spark, n, sys.argv[1]), flush=True)
