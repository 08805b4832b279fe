"""Command line for the two jobs (the reference's two main classes).

    spark-submit trawl/plans/cli.py index --input 's3a://crawl/*.warc.gz' \\
        --gazetteer s3a://ref/gazetteer --output s3a://out/docs [--existing s3a://out/docs-prev] [--hints s3a://lists/hints]
    spark-submit trawl/plans/cli.py text --input ... --domains s3a://lists/ --output s3a://out/text

Next to the output go ``<output>_audit`` (records per drop reason, counted in the job's own
scan) and ``<output>_quarantine`` (corrupt or unparseable records with the
reason; read again without bodies, only if there are any). A result is written to the
side and published only if at most ``--max-failed`` of the records could not be read (5 % as in the reference); else the
old one stays and the command fails, with audit and quarantine written. With ``--upsert`` the output is a table of id buckets, of
which a run rewrites those it touches. Cuts are
options: ``--max-content-bytes`` and ``--per-file`` are off unless given. The
session comes from spark-submit; only settings the results depend on are
applied (``ensure_conf``).
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="trawl")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("index", "text"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True, nargs="+", help="archive files, folders or globs")
        p.add_argument("--output", required=True)
        p.add_argument("--url-pattern")
        p.add_argument("--mime-pattern")
        p.add_argument("--status", choices=["ALL", "SUCCESS"], default="ALL")
        p.add_argument("--max-content-bytes", type=int, help="body bytes kept per record (the reference: 1 MiB)")
        p.add_argument("--max-failed", type=float, default=0.05, help="share of unreadable records up to which the result is published; 1 publishes always")
        p.add_argument("--files", type=int, default=0, help="output files (round-robin); 0 = one per task")
    idx = sub.choices["index"]
    idx.add_argument("--gazetteer", required=True, help="parquet table (spot, title, rho)")
    idx.add_argument("--hints", help="folder of domain-hint files; adds the publication date")
    idx.add_argument("--late", action="store_true", help="two reads: which captures win, then only their bodies")
    idx.add_argument("--upsert", action="store_true", help="merge into the output table in place, bucket by bucket")
    idx.add_argument("--existing", help="previous document table to upsert into")
    idx.add_argument("--format", default="parquet")
    txt = sub.choices["text"]
    txt.add_argument("--domains", required=True, help="folder of domain-list files")
    txt.add_argument("--per-file", type=int, help="captures kept of each source file (the reference: 10)")
    txt.add_argument("--format", default="text", choices=["text", "parquet"],
                     help="gzip text lines as the reference writes them, or parquet rows")
    return ap


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    from pyspark.sql import Observation, SparkSession

    from trawl.operators import filters
    from trawl.operators.snapshot import to_snapshots
    from trawl.plans import jobs
    from trawl.session import Workspace, ensure_conf
    from trawl.sources import sinks
    from trawl.sources.lists import read_domain_hints, read_domain_list
    from trawl.sources.webarchive import read_archive

    spark = ensure_conf(SparkSession.builder.appName(f"trawl-{args.job}").getOrCreate())
    cap = args.max_content_bytes or None
    # both jobs keep responses only (F1): of other records the reader sends no body
    opts = {"responsesOnly": "true", "keepFiltered": "true"}
    if cap:
        opts["maxContentBytes"] = cap
    records = read_archive(spark, args.input, **opts)
    scan = {"url_pattern": args.url_pattern, "mime_pattern": args.mime_pattern, "status_selection": args.status}
    seen = Observation("audit")
    failed = lambda: jobs.failed_share(seen.get)
    over = None
    try:
        if args.job == "index":
            with Workspace(spark) as ws:
                more = dict(cap_bytes=cap, observation=seen, ws=ws, hints=read_domain_hints(spark, args.hints) if args.hints else None, **scan)
                gazetteer = spark.read.parquet(args.gazetteer)
                docs = jobs.archive_documents(spark, args.input, gazetteer, **more) if args.late else jobs.documents(records, gazetteer, **more)
                sinks.within_budget(failed(), args.max_failed)  # the scan is done once the documents are planned
                docs = sinks.fan_out(docs, args.files or None)
                if args.upsert:
                    sinks.upsert_buckets(spark, docs, args.output, order=())
                else:
                    sinks.publish(spark, args.output, lambda at: sinks.upsert_documents(spark, docs, at, args.existing, fmt=args.format, order=()),
                                  failed, args.max_failed)
        else:
            rows = jobs.text_rows(records, read_domain_list(spark, args.domains), per_file=args.per_file, cap_bytes=cap,
                                  observation=seen, **scan)
            write = (lambda at: sinks.write_text(rows, at, files=args.files or None)) if args.format == "text" \
                else (lambda at: sinks.write_rows(rows.select("value"), at, fmt="parquet", files=args.files or None))
            sinks.publish(spark, args.output, write, failed, args.max_failed)
    except sinks.FailureBudgetExceeded as e:
        over = e
    counts = seen.get
    audit = spark.createDataFrame(sorted(counts.items()), "reason string, n long").coalesce(1)
    sinks.write_rows(audit, f"{args.output.rstrip('/')}_audit", fmt="json")
    bare = to_snapshots(read_archive(spark, args.input, columns=[c for c in records.columns if c != "content"]))
    _, bad = filters.split_quarantine(bare if counts[jobs.QUARANTINED] else bare.limit(0))
    keep = ["file", "rec_offset", "rec_index", "url", "quarantine_reason"]
    sinks.write_rows(bad.select(*keep), f"{args.output.rstrip('/')}_quarantine", fmt="json")
    if over:
        raise over


if __name__ == "__main__":
    main()
