"""Command line for cluster runs (``spark-submit formweave/cli.py ...``).

    tables  --profile registry|biorepository --export PATH --dictionary PATH --out DIR
    graph   --dictionary PATH --out DIR
    assets  --config PATH(.yaml|.json) --out DIR [--md5]

Outputs are Parquet below ``--out``.  The session comes from the launcher;
nothing here starts a local master.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from formweave.session import get_spark  # noqa: E402


def _load_config(path: str) -> dict:
    with open(path) as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - optional dependency
            raise SystemExit("YAML configs need PyYAML; pass a JSON config instead") from e
        return yaml.safe_load(text)
    return json.loads(text)


def cmd_tables(spark, args) -> None:
    from formweave.plans.profiles import run_profile
    from formweave.plans.specs import biorepository_profile, registry_profile
    profile = {"registry": registry_profile, "biorepository": biorepository_profile}[args.profile]()
    res = run_profile(spark, profile, args.export, args.dictionary, out_dir=args.out)
    res.column_report.write.mode("errorifexists").parquet(f"{args.out}/_column_report")
    res.validation.write.mode("errorifexists").parquet(f"{args.out}/_validation")
    print(json.dumps({"tables": sorted(res.paths), "missing_dates": res.report["missing_dates"]}))


def cmd_graph(spark, args) -> None:
    from formweave.operators.graph import build_graph
    from formweave.sources.dictionary import read_dictionary
    build_graph(read_dictionary(spark, args.dictionary)).write.mode("errorifexists").parquet(f"{args.out}/edges")


def cmd_assets(spark, args) -> None:
    from formweave.operators.assets import asset_table, content_md5
    conf = _load_config(args.config)
    assets = asset_table(spark, conf)
    assets.write.mode("errorifexists").parquet(f"{args.out}/assets")
    if args.md5:
        globs = [g for b in conf.get("BATCHES", conf).values() for gs in b["FILE_TYPE"].values() for g in gs]
        content_md5(spark, globs).write.mode("errorifexists").parquet(f"{args.out}/md5")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="formweave")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("tables")
    t.add_argument("--profile", choices=["registry", "biorepository"], required=True)
    t.add_argument("--export", required=True)
    t.add_argument("--dictionary", required=True)
    t.add_argument("--out", required=True)
    g = sub.add_parser("graph")
    g.add_argument("--dictionary", required=True)
    g.add_argument("--out", required=True)
    a = sub.add_parser("assets")
    a.add_argument("--config", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--md5", action="store_true")
    args = p.parse_args(argv)
    spark = get_spark()
    {"tables": cmd_tables, "graph": cmd_graph, "assets": cmd_assets}[args.cmd](spark, args)


if __name__ == "__main__":
    main()
