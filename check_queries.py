"""Run registered queries against their DuckDB twins: python check_queries.py [sf_dir] [name ...]"""

import json
import sys
import time

from cohortlens.session import get_session
from cohortlens.plans.registry import all_queries
from cohortlens.plans.compare import compare, duckdb_connection

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session()
    con = duckdb_connection(sf)
    qs = all_queries()
    bad = 0
    for name, qy in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            r = compare(spark, con, qy, sf)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t, 2)
        bad += r["status"] not in ("match", "rows-only")
        print(json.dumps(r), flush=True)
    print(f"{len(qs)} registered, {bad} failing")
