"""Run the release jobs from the command line (``spark-submit`` or ``python -m curatio``).

    python -m curatio release tapping --tables ROOT --excluded CSV --withdrew CSV --out DIR
    python -m curatio baseline --demographics P --profiles P --external-ids CSV --zips P --states P \
        --excluded CSV --withdrew CSV --out DIR
    python -m curatio trials --trials P --crosswalk P --cohort P --excluded CSV --withdrew CSV --out DIR

Tables are Parquet; ``--tables ROOT`` holds one ``<name>.parquet`` per logical
source name of the spec (see ``curatio.plans.curate.SPECS``).  Every command
writes its table under ``--out`` and appends one provenance row to
``--out/provenance``.
"""

from __future__ import annotations

import argparse
import os
import sys

from curatio.functions.rules import START_DATE


def _spark(args):
    from curatio.session import get_spark, scale_conf, ship_package

    conf = scale_conf(int(args.input_bytes)) if args.input_bytes else None
    spark = get_spark(app=f"curatio-{args.cmd}", conf=conf)
    ship_package(spark)
    return spark


def _lists(spark, args):
    from curatio.sources.catalog import read_side_list

    return read_side_list(spark, args.excluded), read_side_list(spark, args.withdrew)


def cmd_release(args) -> None:
    from curatio.plans.curate import SPECS
    from curatio.plans.release import ReleaseOutputs, release
    from curatio.sources.catalog import Catalog

    spark = _spark(args)
    spec = SPECS[args.spec]
    cat = Catalog(spark, root=args.tables)
    frames = {s.table: cat.scan(s.table) for s in spec.sources if s.enabled}
    excluded, withdrew = _lists(spark, args)
    target = spark.read.parquet(cat.path(spec.schema_source)).schema if (args.typed and spec.schema_source) else None
    attachments = spark.read.parquet(args.attachments) if args.attachments else None
    outs = ReleaseOutputs(
        os.path.join(args.out, args.spec),
        os.path.join(args.out, "files") if attachments is not None else None,
        os.path.join(args.out, "documents") if spec.json_columns else None,
        os.path.join(args.out, "provenance"),
    )
    release(spec, frames, excluded, withdrew, outs, attachments=attachments,
            handle_columns=tuple(args.handle_column or ()), target=target, executed=args.executed,
            start=args.start)


def cmd_baseline(args) -> None:
    from curatio.plans.baseline import baseline_characteristics
    from curatio.plans.publish import append_provenance, provenance_with_count, publish
    from curatio.sources.catalog import read_side_list

    spark = _spark(args)
    excluded, withdrew = _lists(spark, args)
    out = baseline_characteristics(
        spark.read.parquet(args.demographics), spark.read.parquet(args.profiles),
        read_side_list(spark, args.external_ids, "id STRING"), excluded, withdrew,
        spark.read.parquet(args.zips), spark.read.parquet(args.states),
        order=args.order, start=args.start, as_of=args.as_of,
    )
    path = os.path.join(args.out, "baseline_characteristics")
    publish(out, path)
    used = [args.demographics, args.profiles, args.external_ids, args.excluded, args.withdrew]
    append_provenance(provenance_with_count(spark.read.parquet(path), "Baseline Characteristics", used, args.executed),
                      os.path.join(args.out, "provenance"))


def cmd_trials(args) -> None:
    from curatio.plans.publish import append_provenance, provenance_with_count, publish
    from curatio.plans.trials import trial_summary

    spark = _spark(args)
    excluded, withdrew = _lists(spark, args)
    out = trial_summary(
        spark.read.parquet(args.trials),
        spark.read.parquet(args.crosswalk) if args.crosswalk else None,
        excluded, withdrew, spark.read.parquet(args.cohort), start=args.start,
    )
    path = os.path.join(args.out, "symbol_substitution_test")
    publish(out, path)
    used = [args.crosswalk, args.trials, args.excluded, args.withdrew, args.cohort]
    append_provenance(provenance_with_count(spark.read.parquet(path), "Voice-based Digital Symbol Substitution Test",
                                            [u for u in used if u], args.executed),
                      os.path.join(args.out, "provenance"))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="curatio")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--excluded", required=True, help="CSV with a healthCode column")
        sp.add_argument("--withdrew", required=True, help="CSV with a healthCode column")
        sp.add_argument("--out", required=True)
        sp.add_argument("--start", default=START_DATE)
        sp.add_argument("--executed", default=None, help="code reference recorded in the provenance row")
        sp.add_argument("--input-bytes", default=None, help="input volume, sizes shuffle partitions")

    from curatio.plans.curate import SPECS

    r = sub.add_parser("release", help="one of the 15 standard tables")
    r.add_argument("spec", choices=sorted(SPECS), help="table spec name")
    r.add_argument("--tables", required=True, help="folder with <source>.parquet per spec source")
    r.add_argument("--attachments", default=None, help="Parquet (handle, content) of attachment payloads")
    r.add_argument("--handle-column", action="append", help="attachment column to re-home (repeatable)")
    r.add_argument("--typed", action="store_true", help="project onto the schema of the spec's schema source")
    common(r)
    r.set_defaults(fn=cmd_release)

    b = sub.add_parser("baseline", help="baseline characteristics")
    for a in ("--demographics", "--profiles", "--external-ids", "--zips", "--states"):
        b.add_argument(a, required=True)
    b.add_argument("--order", default="ROW_ID", help="row-order column present in both sources")
    b.add_argument("--as-of", default=None, help="'today' for the years-since columns (default: current date)")
    common(b)
    b.set_defaults(fn=cmd_baseline)

    t = sub.add_parser("trials", help="symbol substitution test block summary")
    t.add_argument("--trials", required=True)
    t.add_argument("--crosswalk", default=None)
    t.add_argument("--cohort", required=True, help="released baseline table (healthCode)")
    common(t)
    t.set_defaults(fn=cmd_trials)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main(sys.argv[1:])
