"""Run a registered query in Spark and its oracle SQL in DuckDB, then compare.

Used by the test-suite and as a command-line check:

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from statline.sources.fixtures import BASE_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, digits):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if digits is None:
            return v
        return float(f"{v:.{digits}g}")
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def _rows(pdf: pd.DataFrame, digits):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, digits) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def _close(pa: pd.DataFrame, pb: pd.DataFrame) -> bool:
    """Rows paired by an 8-significant-digit sort key, then compared with tolerance."""
    def keyed(pdf):
        cols = sorted(pdf.columns)
        recs = list(pdf[cols].itertuples(index=False, name=None))
        pairs = [(repr(tuple(_norm(v, 8) for v in r)), tuple(_norm(v, None) for v in r))
                 for r in recs]
        return [p[1] for p in sorted(pairs, key=lambda p: p[0])]
    for ra, rb in zip(keyed(pa), keyed(pb)):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, float):
                if not math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                    return False
            elif x != y:
                return False
    return True


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    from statline.plans.registry import ORACLES, QUERIES

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    rows = [r.asDict() for r in sdf.collect()]
    spark_pdf = pd.DataFrame(rows, columns=sdf.columns)
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(spark_pdf), "spark_sec": round(t_spark, 2)}
    if name not in ORACLES:
        res["status"] = "rows-only"
        return res
    duck_pdf = con.execute(ORACLES[name]).fetchdf()
    res["oracle_rows"] = len(duck_pdf)
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        res["status"] = "COLUMNS"
        res["detail"] = (sorted(set(spark_pdf.columns) ^ set(duck_pdf.columns)))
        return res
    if len(spark_pdf) != len(duck_pdf):
        res["status"] = "ROWCOUNT"
        return res
    exact = _rows(spark_pdf, None) == _rows(duck_pdf, None)
    close = exact or _close(spark_pdf, duck_pdf)
    res["status"] = "exact" if exact else ("close" if close else "VALUES")
    if not close:
        a, b = _rows(spark_pdf, 10), _rows(duck_pdf, 10)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        res["detail"] = {"cols": sorted(spark_pdf.columns), "first_diffs": diff}
    return res


def main(argv):
    from statline.plans.registry import QUERIES
    from statline.session import get_spark

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = get_spark(shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("exact", "close", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
