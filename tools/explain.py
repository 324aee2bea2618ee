"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py [--run] [sf_dir] key [key ...]
With --run the query is executed first (noop sink), so the adaptive plan
shown is the final one.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    run = "--run" in args
    args = [a for a in args if a != "--run"]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    from ovenplan.plans.registry import queries
    from ovenplan.session import local_session

    spark = local_session(8, 16)
    qs = queries()
    for key in args:
        df = qs[key](spark, sf)
        if run:
            df.write.format("noop").mode("overwrite").save()
        print(f"==== {key}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
