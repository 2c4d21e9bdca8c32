"""Print the formatted physical plan of registered queries.
Usage: python tools/explain.py [sf_dir] name [name ...]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans import catalog  # noqa: E402
from strata.plans.warehouse import Warehouse  # noqa: E402
from strata.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    wh = Warehouse(spark, sf)
    for name in args:
        print(f"==================== {name}")
        catalog.build(wh, name).explain("formatted")


if __name__ == "__main__":
    main()
