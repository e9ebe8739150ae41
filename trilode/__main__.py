"""``spark-submit``-able entry: run chosen layers of a ready-made flow or of a JSON config."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from trilode.plans.config import flow_from_config
from trilode.plans.domains import DOMAINS
from trilode.plans.run import run
from trilode.spec import LAYERS, FileSource


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="trilode", description=__doc__)
    parser.add_argument("--domain", choices=sorted(DOMAINS), default="sales")
    parser.add_argument("--config", help="JSON file with a flow, instead of a ready-made one")
    parser.add_argument("--overrides", help="JSON file with blocks that replace those of the config")
    parser.add_argument("--root", help="folder or URI that holds the layers")
    parser.add_argument("--input", help="source path, instead of the flow's own")
    parser.add_argument("--layer", action="append", choices=LAYERS, help="may be repeated")
    for layer in LAYERS:
        parser.add_argument(f"--{layer}", action="store_true", help=f"only the {layer} layer")
    return parser.parse_args(argv)


def chosen_layers(args: argparse.Namespace) -> list[str]:
    """``--layer`` wins over the single-layer flags; nothing chosen means all."""
    if args.layer:
        return args.layer
    flagged = [layer for layer in LAYERS if getattr(args, layer)]
    return flagged[:1] or list(LAYERS)


def loaded(path: str) -> dict:
    with open(path, encoding="utf-8") as text:
        return json.load(text)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    spark = SparkSession.builder.appName("trilode").getOrCreate()
    if args.config:
        overrides = loaded(args.overrides) if args.overrides else None
        flow = flow_from_config(loaded(args.config), overrides, root=args.root)
    else:
        flow = DOMAINS[args.domain](args.root or "data")
    if args.input:
        if not isinstance(flow.source, FileSource):
            raise SystemExit("--input replaces the path of a file source; this flow reads a query")
        flow = flow.override(source=replace(flow.source, path=args.input))
    results = run(spark, flow, chosen_layers(args))
    for r in results.values():
        outcome = "ok" if r.success else f"failed: {r.error}"
        print(f"{r.layer}: {r.seconds:.2f}s in={r.input_rows} out={r.output_rows} {outcome}")
    return 0 if all(r.success for r in results.values()) else 1


if __name__ == "__main__":
    sys.exit(main())
