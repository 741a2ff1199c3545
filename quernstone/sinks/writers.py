"""Payloads to files.

Documents (JSON, YAML) are written by the driver; they are published collections, small by nature,
and their rows come in through one ordered iterator. A Parquet file of its own metadata is sorted by
the executors and put together from their files; tables without order go through Spark's own writer
(``parquet-dir``, ``jsonl``).
"""

from __future__ import annotations

import json
import math
import shutil
import subprocess
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quernstone.errors import DeliveryError, EngineError
from quernstone.model import RunContext, Target
from quernstone.operators.shard import sort_key
from quernstone.session import shared_folder


@dataclass
class Payload:
    """Rows and what is wrapped around them: nothing, a collection or a mapping package.

    ``df`` may have an ``ord`` column; it gives the order and is not written.
    """

    df: DataFrame
    envelope: dict | None = None
    items_key: str | None = None

    def ordered(self) -> DataFrame:
        return self.df.orderBy("ord").drop("ord") if "ord" in self.df.columns else self.df

    def rows(self) -> list[dict]:
        return [_present(r.asDict(True)) for r in self.ordered().toLocalIterator()]

    def document(self) -> object:
        if self.items_key is None:
            return self.rows()
        return {**(self.envelope or {}), self.items_key: self.rows()}


def _present(v: object) -> object:
    """Without fields that are null."""
    if isinstance(v, dict):
        return {k: _present(x) for k, x in v.items() if x is not None}
    return [_present(x) for x in v] if isinstance(v, list) else v


def write_json(p: Payload, path: Path) -> None:
    path.write_text(json.dumps(p.document(), indent=2, ensure_ascii=False), "utf-8")


def write_yaml(p: Payload, path: Path) -> None:
    path.write_text(yaml.safe_dump(p.document(), sort_keys=True, allow_unicode=True), "utf-8")


def write_parquet(p: Payload, path: Path) -> None:
    """One file, sorted by notation or identifier (stable), the scheme in its metadata.

    The executors sort in ranges and write a file each to the shared folder; those are put together
    batch by batch, so the driver never holds the table.
    """
    keys = [sort_key(p.df), *([F.col("ord")] if "ord" in p.df.columns else [])]
    spark = p.df.sparkSession
    folder = f"{shared_folder(spark)}/sorted-{uuid.uuid4().hex}"
    p.df.orderBy(*keys).drop("ord").write.parquet(folder)
    meta = {k: str(v) for k, v in (p.envelope or {}).items()}
    fs, root = pafs.FileSystem.from_uri(folder if "://" in folder else Path(folder).absolute().as_uri())
    try:
        parts = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.startswith("part-"))  # numbered in the order of the ranges
        kinds = to_arrow_schema(p.df.drop("ord").schema).with_metadata(meta or None)
        with pq.ParquetWriter(path, kinds, compression="snappy") as out:
            for part in parts:
                with fs.open_input_file(part) as f:
                    for batch in pq.ParquetFile(f).iter_batches():
                        out.write_table(pa.Table.from_batches([batch]).replace_schema_metadata(None).cast(kinds.remove_metadata()).replace_schema_metadata(meta or None))
    finally:
        fs.delete_dir(root)


def write_parquet_dir(p: Payload, path: Path) -> None:
    p.df.drop("ord").write.mode("overwrite").parquet(str(path))


def write_jsonl(p: Payload, path: Path) -> None:
    p.df.drop("ord").write.mode("overwrite").json(str(path))


Writer = Callable[[Payload, Path], None]
_WRITERS: dict[str, Writer] = {}
EXTENSIONS = {"json": ".json", "yaml": ".yaml", "parquet": ".parquet", "parquet-dir": ".parquet", "jsonl": ".jsonl"}


def register(format: str, writer: Writer, extension: str | None = None) -> None:
    _WRITERS[format] = writer
    EXTENSIONS[format] = extension or EXTENSIONS.get(format, f".{format}")


for _f, _w in {"json": write_json, "yaml": write_yaml, "parquet": write_parquet, "parquet-dir": write_parquet_dir, "jsonl": write_jsonl}.items():
    register(_f, _w)


def write(p: Payload, path: Path, format: str) -> Path:
    """Writes and makes the folders needed; an unknown format is an error."""
    if format not in _WRITERS:
        raise EngineError(f"no writer for {format!r}")
    path.parent.mkdir(parents=True, exist_ok=True)
    _WRITERS[format](p, path)
    return path


def shard_file(path: Path, limit: int) -> list[Path]:
    """Cuts a Parquet file into contiguous slices of at most ``limit`` bytes each (zstd), named stem-01 and so on.

    The number of slices starts at size / limit and grows by one until all fit; a slice of one row
    may be larger. Row order and metadata stay.
    """
    table = pq.read_table(path)

    def at(n: int, folder: Path) -> list[Path]:
        size = -(-table.num_rows // n) or 1
        out = []
        for i in range(n):
            part = table.slice(i * size, size)
            if i and not part.num_rows:
                break
            out.append(folder / f"{path.stem}-{i + 1:02d}.parquet")
            pq.write_table(part, out[-1], compression="zstd", compression_level=9)
        return out

    n = max(1, math.ceil(path.stat().st_size / limit))
    while True:
        made = at(n, path.parent)
        if all(p.stat().st_size <= limit for p in made) or n >= max(1, table.num_rows):
            return made
        for p in made:
            p.unlink()
        n += 1


def sector_metadata(folder: Path, sector: str, title: str, description: str, version: str = "0.1.0") -> Path:
    """metadata.json of a sector's folder (rank-name), with row counts from the Parquet footers."""
    rank, _, name = sector.partition("-")
    counts = {p.name: pq.read_metadata(p).num_rows for p in sorted(folder.glob("*.parquet"))}
    path = folder / "metadata.json"
    path.write_text(json.dumps({"sector": name, "title": title, "description": description, "rank": int(rank), "schema_version": version, "row_counts": counts}, indent=2), "utf-8")
    return path


def deliver_local(files: list[Path], target: Target, category: str, root: Path) -> list[Path]:
    """Copies files into ``root``/subdir/category; files of the same stem and another suffix are removed."""
    if not root.is_dir():
        raise DeliveryError(f"no such folder: {root}")
    folder = root / target.output_subdir / category
    folder.mkdir(parents=True, exist_ok=True)
    out = []
    for f in files:
        for old in folder.glob(f"{f.stem}.*"):
            if old.name != f.name:
                old.unlink()
        out.append(Path(shutil.copy2(f, folder / f.name)))
    return out


def deliver(files: list[Path], target: Target, name: str, ctx: RunContext, workdir: Path, run: Callable = subprocess.run) -> bool:
    """Clones the target, copies the files into its folder on a branch, commits, pushes and opens a pull request.

    Does nothing in a dry run. ``run`` executes a command line and can be replaced.
    """
    if ctx.dry_run:
        return False
    clone, branch = workdir / target.name, f"import/{name}"
    steps = [["git", "clone", "--depth", "1", target.repo, str(clone)], ["git", "-C", str(clone), "checkout", "-b", branch]]
    after = [["git", "-C", str(clone), "add", target.output_subdir], ["git", "-C", str(clone), "commit", "-m", f"Import {name}"], ["git", "-C", str(clone), "push", "-u", "origin", branch], ["gh", "pr", "create", "--repo", target.repo, "--head", branch, "--title", f"Import {name}", "--body", f"Import of {name}."]]
    try:
        for s in steps:
            run(s, check=True, capture_output=True)
        folder = clone / target.output_subdir
        folder.mkdir(parents=True, exist_ok=True)
        for f in files:
            shutil.copy2(f, folder / f.name)
        for s in after:
            run(s, check=True, capture_output=True)
    except (OSError, subprocess.CalledProcessError) as e:
        raise DeliveryError(f"delivery of {name} failed: {e}") from e
    return True
