"""Checks every registered query against its SQL: ``python tests/check_oracles.py [names…]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from panelprep.session import local_session  # noqa: E402
from tests.oracle_compare import compare, connect  # noqa: E402


def main() -> int:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[1:] or list(queries)
    spark, con = local_session("check", 8), connect(sf_dir)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, queries[name], oracles[name])
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        tag = "ok  " if problem is None else "FAIL"
        print(f"{tag} {name} {'' if name in oracles else '(rows only) '}{time.time() - begin:.1f}s", problem or "", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
