"""Run registered queries against their oracle: ``check_queries.py SF [names...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from compare import compare, connect  # noqa: E402

from pulse.plans.all_queries import ORACLES, QUERIES  # noqa: E402
from pulse.session import local_session  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    folder = f"/root/testdata/{sf}"
    spark, con = local_session("8"), connect(folder)
    bad = 0
    picked = [q for q in QUERIES if not names or any(q.startswith(n) for n in names)]
    for name in picked:
        t = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
                note = "ok"
            else:
                n = df.count()
                problems, note = ([] if n else ["no rows"]), f"{n} rows"
        except Exception as e:  # noqa: BLE001
            problems = [str(e)[:700]]
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'pass'} {name} {time.time() - t:.1f}s {problems or note}", flush=True)
    print(f"{len(picked) - bad}/{len(picked)} agree")
    return bad


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "-v"]
    sys.exit(bool(main(args[0], args[1:])))
