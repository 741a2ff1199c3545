"""Command line: list, validate and run sources, run a family on one parse, audit what was staged, cut files into slices."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from quernstone.errors import EngineError
from quernstone.model import RunContext
from quernstone.plans import audit, pipeline, registry
from quernstone.session import session, ship
from quernstone.sinks import writers


def _context(a: argparse.Namespace) -> RunContext:
    some = lambda v: Path(v) if v else None
    return RunContext(Path(a.cache_dir), Path(a.output_dir), not getattr(a, "deliver", False), a.offline, some(a.schema_dir), some(a.existing), some(getattr(a, "deliver_local", None)))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quernstone")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("list", "validate", "run", "family", "audit", "shard"):
        c = sub.add_parser(name)
        if name == "shard":
            c.add_argument("files", nargs="+", type=Path)
            c.add_argument("--limit", type=int, default=2_500_000, help="bytes of a slice")
            continue
        c.add_argument("--registry", help="YAML file of sources beside the built-in ones")
        if name == "list":
            continue
        if name == "audit":
            c.add_argument("--output-dir", default="out")
            c.add_argument("--expected", type=int)
            continue
        c.add_argument("prefix" if name == "family" else "source", nargs="?" if name == "run" else None)
        c.add_argument("--cache-dir", default=".cache")
        c.add_argument("--output-dir", default="out")
        c.add_argument("--offline", action="store_true")
        c.add_argument("--schema-dir")
        c.add_argument("--existing", help="checkout of the published collections")
        if name in ("run", "family"):
            c.add_argument("--deliver-local", metavar="PATH")
        if name == "run":
            c.add_argument("--all", action="store_true")
            c.add_argument("--deliver", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        if a.command == "shard":
            for f in a.files:
                if not f.exists():
                    raise EngineError(f"no such file: {f}")
                for part in writers.shard_file(f, a.limit):
                    print(f"wrote {part}")
            return 0
        configs = registry.builtin() + (registry.load(Path(a.registry)) if a.registry else [])
        if a.command == "list":
            for c in configs:
                print(f"{c.name:40} {c.target}/{c.category} [{'enabled' if c.enabled else 'disabled'}]")
            return 0
        spark = session()
        ship(spark)
        if a.command == "validate":
            print(f"{a.source}: {pipeline.validate(spark, registry.get(a.source, configs), _context(a))} rows valid")
            return 0
        if a.command == "audit":
            rows = audit.audit(spark, Path(a.output_dir), a.expected).collect()
            for r in rows:
                print(f"{'PASS' if r['ok'] else 'FAIL'} {r['check']} {r['detail'] or ''}".rstrip())
            return 0 if all(r["ok"] for r in rows) else 1
        if a.command == "family":
            for path in pipeline.run_family(spark, [c for c in configs if c.name.startswith(a.prefix)], _context(a)):
                print(f"wrote {path}")
            return 0
        if not a.all and not a.source:
            raise EngineError("run needs a source or --all")
        for c in [c for c in configs if c.enabled] if a.all else [registry.get(a.source, configs)]:
            print(f"wrote {pipeline.run(spark, c, _context(a))}")
    except EngineError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
