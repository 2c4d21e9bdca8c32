"""Build and publish warehouse tables.

    python -m strata.build --sf-dir /root/testdata/sf0.01 --out /shared/warehouse [name ...]

Each table is computed from the raw feeds through silver and gold and
published as a new version folder with a current-version pointer
(``strata.sources.sinks.publish``).  Without names, every registered table is
published.  On a cluster the output folder must be shared storage.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from strata.plans import catalog
from strata.plans.warehouse import Warehouse
from strata.session import build_session
from strata.sources import sinks


def publish_tables(wh: Warehouse, out: str, names: list[str] | None = None, run_ts=None) -> dict[str, str]:
    """Publish the tables under one run time: that of the call, in UTC, unless given."""
    run_ts = run_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    paths = {}
    for name in names or catalog.names():
        paths[name] = sinks.publish(catalog.build(wh, name), out, name, run_ts)
    return paths


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    paths = publish_tables(Warehouse(spark, a.sf_dir), a.out, a.names or None)
    print(json.dumps(paths, indent=1))


if __name__ == "__main__":
    main()
