"""Command line runs: the collector and the processor.

    python -m newsflow collect --pages PAGES.parquet --store STORE_DIR [--json OUT_DIR]
    python -m newsflow process --store STORE_DIR --generate pkg.module:function
                               [--partitions N]
    python -m newsflow compact --store STORE_DIR

``--generate`` names a batch model function ``(requests DataFrame) ->
answers DataFrame`` (see ``newsflow.operators.enrich``).
"""

from __future__ import annotations

import argparse
import importlib

from newsflow.operators import store as S
from newsflow.plans import collect as C
from newsflow.session import get_spark


def _load(spec: str):
    mod, _, fn = spec.partition(":")
    return getattr(importlib.import_module(mod), fn)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="newsflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("collect")
    c.add_argument("--pages", required=True)
    c.add_argument("--store", required=True)
    c.add_argument("--json")
    p = sub.add_parser("process")
    p.add_argument("--store", required=True)
    p.add_argument("--generate", required=True)
    p.add_argument("--partitions", type=int)
    k = sub.add_parser("compact")
    k.add_argument("--store", required=True)
    a = ap.parse_args(argv)
    spark = get_spark()
    if a.cmd == "collect":
        pages = spark.read.parquet(a.pages).select("page_id", "url", "html")
        r = C.collect(spark, pages, a.store, json_path=a.json).first()
        print(f"store: added {r.added}, skipped {r.skipped}, quarantined {r.quarantined}")
    elif a.cmd == "process":
        r = C.process(spark, a.store, _load(a.generate), partitions=a.partitions).first()
        print(f"store commit {r.commit}: {r.ready} ready, {r.error} error")
    else:
        print(f"prefixes rewritten: {len(S.compact(spark, a.store))}")


if __name__ == "__main__":
    main()
