"""Command line: python -m citeloom.cli run|variant|doctor|preset|bootstrap."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

import yaml

from citeloom.plans import config as cfg
from citeloom.plans import stages


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="citeloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "doctor"):
        p = commands.add_parser(name)
        p.add_argument("--preset", default="offline")
        p.add_argument("--config")
        p.add_argument("--set", action="append", default=[], dest="overrides")
        p.add_argument("--root", default="runs")
    p = commands.add_parser("variant")
    p.add_argument("source")
    p.add_argument("--set", action="append", default=[], dest="overrides")
    p.add_argument("--start")
    p.add_argument("--root", default="runs")
    p.add_argument("--dry-run", action="store_true")
    p = commands.add_parser("preset")
    p.add_argument("name", nargs="?")
    p.add_argument("--write", metavar="FILE")
    p = commands.add_parser("bootstrap")
    p.add_argument("folder")
    p.add_argument("--preset", default="offline")
    args = parser.parse_args(argv)
    if args.command == "preset":
        if args.name and args.name not in cfg.PRESETS:
            parser.error(f"unknown preset {args.name!r}; known: {', '.join(cfg.PRESETS)}")
        if args.write:
            _write_config(args.write, args.name or "offline")
        else:
            print("\n".join(cfg.PRESETS) if not args.name else yaml.safe_dump(cfg.PRESETS[args.name]))
        return 0
    if args.command == "bootstrap":
        for part in ("runs", "sources", "cache"):
            Path(args.folder, part).mkdir(parents=True, exist_ok=True)
        if not (target := Path(args.folder, "config.yaml")).exists():  # a configuration that is there is somebody's work
            _write_config(str(target), args.preset)
        return 0
    if args.command == "variant":
        variant = stages.plan_variant(args.source, dict(map(cfg.parse_override, args.overrides)), args.start, _session() if "://" in args.source else None)
        print(variant.text())
        if not args.dry_run:
            stages.run_variant(_session(), variant, args.root)
        return 0
    config = cfg.load(args.preset, args.config, args.overrides)
    found = stages.doctor(config)
    print("\n".join(found) or "nothing stands in the way")
    if args.command == "run" and not found:
        print(stages.run(_session(), config, args.root).folder)
    return int(bool(found))


def _write_config(path: str, preset: str) -> None:
    """All settings of a preset, for a person to change."""
    Path(path).write_text(yaml.safe_dump(json.loads(json.dumps(cfg.as_dict(cfg.load(preset)))), sort_keys=False), encoding="utf-8")


def _session():
    from pyspark.sql import SparkSession

    from citeloom.sources.rest import LiteratureSource

    spark = SparkSession.builder.appName("citeloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.dataSource.register(LiteratureSource)
    return spark


if __name__ == "__main__":
    raise SystemExit(main())
