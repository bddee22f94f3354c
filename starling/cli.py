"""Command line: run the two streaming queries, inspect, compact, reset.

    python -m starling.cli run --source <landing area> --state <state folder> [--once] [--every "1 minute"]
    python -m starling.cli diagnose --state <state folder>
    python -m starling.cli compact --state <state folder>
    python -m starling.cli reset --state <state folder> [--replay]

The session is the submitter's; only ``--master`` makes one with settings of its own. ``diagnose`` prints every row.
``reset`` prints the folder of a fresh, empty state beside this one (nothing is removed); with ``--replay`` all that has
landed is processed into it again, without reading source files.

``run`` starts the file ingest (query 1) and the transform (query 2). With ``--once`` both drain what is
there (``availableNow``) and stop; otherwise they trigger every ``--every``. The scheduler of the
reference (tasks, resume/suspend) is the caller's job runner; this is the process it starts.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from starling.plans import diagnostics
from starling.session import build_session
from starling.store.tables import Store
from starling.streaming.ingest import start_ingest
from starling.streaming.progress import ProgressRecorder
from starling.streaming.replay import replay
from starling.streaming.transform import run_until_drained, start_transform


def _run(spark, args) -> None:
    st = Store(spark, args.state, args.money)
    spark.streams.addListener(ProgressRecorder(spark, f"{st.root}/load_progress"))
    how = dict(strict=not args.permissive, strict_dims=args.strict_dims, compact_every=args.compact_every)
    how["publish_changes"] = args.changes
    take = dict(fmt=args.format, max_bytes_per_trigger=args.max_bytes, archive=args.archive)
    if args.once:
        run_until_drained(start_ingest(spark, args.source, st, args.max_files, **take))
        run_until_drained(start_transform(spark, st, **how))
        return
    q1 = start_ingest(spark, args.source, st, args.max_files, available_now=False, processing_time=args.every, **take)
    q2 = start_transform(spark, st, available_now=False, processing_time=args.every, **how)
    spark.streams.awaitAnyTermination()
    for q in (q1, q2):
        if q.exception() is not None:
            raise q.exception()


def _print_all(title: str, df) -> None:
    print(f"-- {title}: {', '.join(df.columns)}")
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def _diagnose(spark, args) -> None:
    st = Store(spark, args.state, args.money)
    counts = diagnostics.layer_counts([
        ("RAW", "landing", st.landing()),
        *[("STAGED", t, st.current(t)) for t in ("stg_orders", "stg_order_items")],
        *[("CURATED", t, st.current(t)) for t in ("dim_customer", "dim_product", "fact_orders", "fact_order_items")],
        ("REJECTS", "rejects", st.log("rejects")),
    ])
    _print_all("layers", counts.unionByName(diagnostics.pending_counts(st)))
    landing = st.landing()
    _print_all("load history", diagnostics.load_history(landing, hours=args.hours).orderBy("file_name"))
    _print_all("load usage", diagnostics.load_usage(landing, hours=args.hours).orderBy("hour_start"))
    _print_all("runs", diagnostics.runs(st.audit()))
    _print_all("steps", diagnostics.run_history(st.audit(), "procedure_name", "sp%", "event_ts"))
    _print_all("batches", diagnostics.batch_summary(st.audit(), st.commits()).orderBy(F.col("batch_id").desc()))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="starling")
    p.add_argument("command", choices=["run", "diagnose", "compact", "reset"])
    p.add_argument("--state", required=True)
    p.add_argument("--source")
    p.add_argument("--once", action="store_true")
    p.add_argument("--every", default="1 minute")
    p.add_argument("--max-files", type=int, default=None)
    p.add_argument("--max-bytes", type=int, default=None)
    p.add_argument("--archive", help="folder to which loaded files are moved")
    p.add_argument("--changes", action="store_true", help="append each batch's change images to the change log")
    p.add_argument("--replay", action="store_true")
    p.add_argument("--money", default="number", choices=["number", "cents"])
    p.add_argument("--permissive", action="store_true")
    p.add_argument("--strict-dims", action="store_true", help="fail a batch with conflicting dimension values")
    p.add_argument("--format", default="array", choices=["array", "lines"])
    p.add_argument("--hours", type=int, default=48)
    p.add_argument("--compact-every", type=int, default=None, help="compact after every N-th batch")
    p.add_argument("--master", default=None)
    args = p.parse_args(argv)
    spark = build_session(master=args.master)
    if args.command == "run":
        _run(spark, args)
    elif args.command == "diagnose":
        _diagnose(spark, args)
    elif args.command == "reset":
        st = Store(spark, args.state, args.money)
        fresh = replay(spark, st, strict=not args.permissive, strict_dims=args.strict_dims) if args.replay else st.reset()
        print("fresh state", fresh.root)
    else:
        print("compacted up to batch", Store(spark, args.state, args.money).compact())


if __name__ == "__main__":
    main()
