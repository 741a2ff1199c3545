"""From a declared source to files: fetch, read, transform, dedup, wrap, validate, write, deliver."""

from __future__ import annotations

import logging
import tempfile
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quernstone.errors import ValidationError
from quernstone.model import RunContext, SourceConfig, Target, target
from quernstone.operators import dedup
from quernstone.functions.routing import SECTOR_TITLES, SECTORS
from quernstone.sinks import writers
from quernstone.sources import families
from quernstone.validate import schema

log = logging.getLogger("quernstone")


def existing(spark: SparkSession, config: SourceConfig, ctx: RunContext) -> DataFrame | None:
    """(iri, pref_label) of what is published in the category's folder (YAML and Parquet collections)."""
    if ctx.existing_root is None:
        raise ValidationError(f"source {config.name!r} is checked against what is published: name its checkout (--existing)")
    folder = ctx.existing_root / "data" / config.category
    if not folder.is_dir():
        return None
    rows = []
    for f in sorted([*folder.glob("*.yaml"), *folder.glob("*.yml")]):
        doc = yaml.safe_load(f.read_text("utf-8")) or {}
        rows += [(i.get("iri"), i.get("pref_label")) for i in doc.get(config.items_key) or []]
    out = spark.createDataFrame(rows, T.StructType([T.StructField("iri", T.StringType()), T.StructField("pref_label", T.StringType())]))
    files = [str(f) for f in folder.glob("*.parquet")]
    return out.unionByName(spark.read.parquet(*files).select("iri", "pref_label")) if files else out


def deduplicated(df: DataFrame, config: SourceConfig, to: Target, ctx: RunContext) -> DataFrame:
    """Equal rows collapse, differing ones raise; then the policy against what is published. Collisions of labels are logged."""
    if config.on_existing not in dedup.POLICIES:
        raise ValidationError(f"unknown policy {config.on_existing!r}")
    if "iri" not in df.columns:
        return df
    df = dedup.intra(df)
    for r in dedup.label_collisions(df).limit(20).collect():
        log.warning("label %r of %s is first that of %s", r["pref_label"], r["iri"], r["first"])
    if config.check_existing and to.schema_ref and config.items_key:
        old = existing(df.sparkSession, config, ctx)
        if old is not None:
            df = dedup.against(df, old, config.on_existing)
            for r in dedup.existing_collisions(df, old).limit(20).collect():
                log.warning("label %r of %s is published as %s", r["pref_label"], r["iri"], r["existing"])
    return df


def wrapped(df: DataFrame, config: SourceConfig) -> writers.Payload:
    """A package if the source has a verb, else a collection if it has a class, else bare rows."""
    if config.package_verb:
        return writers.Payload(df, {"name": config.package_name, "version": config.package_version}, config.package_verb)
    if config.collection:
        return writers.Payload(df, {"scheme": config.scheme}, config.items_key)
    return writers.Payload(df)


def schema_path(config: SourceConfig, name: str, to: Target, ctx: RunContext) -> Path:
    if ctx.schema_dir is None:
        raise ValidationError(f"schema {name!r} of {to.name!r} is not there: name a schema folder")
    path = ctx.schema_dir / f"{name}.yaml"
    if not path.exists():
        raise ValidationError(f"no schema {name!r} in {ctx.schema_dir}")
    return path


def checked(p: writers.Payload, config: SourceConfig, to: Target, ctx: RunContext) -> None:
    if config.package_verb:
        schema.validate(p.df, "package", p.envelope)
    elif config.collection:
        if not config.schema_file:
            raise ValidationError(f"source {config.name!r} has a collection but no schema file")
        schema.validate(p.df, "collection", p.envelope, schema_path(config, config.schema_file, to, ctx), config.collection)
    elif config.item_class:
        schema.validate(p.df, to.validator, p.envelope, schema_path(config, config.item_class, to, ctx), config.item_class)


def produce(spark: SparkSession, config: SourceConfig, ctx: RunContext, records: DataFrame | None = None) -> writers.Payload:
    """The validated payload. ``records`` are read once and given to several sources by :func:`run_family`."""
    s, to = families.source(config), target(config.target)
    df = deduplicated(s.transform(records if records is not None else s.read(spark, ctx)), config, to, ctx)
    p = wrapped(df, config)
    checked(p, config, to, ctx)
    return p


def validate(spark: SparkSession, config: SourceConfig, ctx: RunContext) -> int:
    """Rows that would be written."""
    return produce(spark, config, ctx).df.count()


def run(spark: SparkSession, config: SourceConfig, ctx: RunContext, records: DataFrame | None = None) -> Path:
    p, to = produce(spark, config, ctx, records), target(config.target)
    path = ctx.output_dir / config.target / config.category / f"{config.emit or config.name}{writers.EXTENSIONS[config.output]}"
    writers.write(p, path, config.output)
    if ctx.deliver_root is not None:
        writers.deliver_local([path], to, config.category, ctx.deliver_root)
    if not ctx.dry_run:
        with tempfile.TemporaryDirectory() as d:
            writers.deliver([path], to, config.name, ctx, Path(d))
    return path


def run_family(spark: SparkSession, configs: list[SourceConfig], ctx: RunContext) -> list[Path]:
    """Several sources; those of one input share one parse, written once and read by each. Sector folders get their metadata."""
    from quernstone.session import cut

    parsed: dict[tuple, DataFrame] = {}
    out = []
    for c in configs:
        s = families.source(c)
        k = (c.url, c.format, type(s).read)
        if k not in parsed:
            parsed[k] = cut(s.read(spark, ctx))
        out.append(run(spark, c, ctx, parsed[k]))
    for folder in sorted({p.parent for c, p in zip(configs, out, strict=True) if c.target == "inventory" and c.category in SECTORS}):
        out.append(writers.sector_metadata(folder, folder.name, SECTOR_TITLES[folder.name], f"Source: {families.LciSource.citation}."))
    return out
