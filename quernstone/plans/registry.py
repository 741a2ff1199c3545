"""The sources the engine knows, built from rules, and those of a YAML file.

File paths of licensed inputs are parameters: ``QUERNSTONE_SOURCES`` names their folder.
"""

from __future__ import annotations

import os
from dataclasses import fields
from pathlib import Path

import yaml

from quernstone.errors import RegistryError
from quernstone.functions.ids import BASE
from quernstone.functions.routing import SECTORS
from quernstone.model import SourceConfig

INPUTS = os.environ.get("QUERNSTONE_SOURCES", "/data/sources")
#: Fixed value: the pinned food catalogue.
FOOD_URL = "https://raw.githubusercontent.com/openefsa/efsa-catalogues/242ead56e40a29002a66d63fc64c6a497151af4b/ecf_catalogues/MTX.ecf"
#: Compartments that flow terms are cut into.
EF_COMPARTMENTS = ["air", "water", "soil", "land-use", "natural-resource", "biota"]
LCI_COMPARTMENTS = ["emissions-to-air", "emissions-to-water", "emissions-to-soil", "resources", "non-material-emissions", "economic-issues"]


def _url(name: str) -> str:
    return f"file://{INPUTS}/{name}"


SHEET, FACTORS, FLOWS, LCI = _url("reference_synthese.parquet"), _url("ef_factors.parquet"), _url("harmonised-flows.json.gz"), _url("ecospold1.zip")
CURATED, DEBRIDGED = _url("mappings_biosphere.parquet"), _url("mappings_biosphere_ef.parquet")


def _vocab(name: str, family: str, category: str, url: str, format: str, key: str, cls: str, file: str, output: str = "parquet", emit: str | None = None, check: bool = False, options: dict | None = None, scheme: str | None = None) -> SourceConfig:
    return SourceConfig(name, family, "vocab", category, url, format, output, item_class=cls, emit=emit, collection=f"{cls}Collection", items_key=key, scheme=f"{BASE}/{scheme or category}/", schema_file=file, check_existing=check, options=options or {})


def _provenance(name: str, emit: str | None, id_: str, label: str, title: str, creators: list[str], publisher: str, identifier: str) -> SourceConfig:
    record = {"id": id_, "label": label, "title": title, "creators": creators, "publisher": publisher, "identifier": identifier, "citation": f"{', '.join(creators)}: {title}. {publisher}."}
    return _vocab(name, "Static", "sources", f"static://{name}", "json", "sources", "Source", "source", "yaml", emit, options=record)


def _package(name: str, family: str, category: str, url: str, package: str, emit: str | None, options: dict) -> SourceConfig:
    return SourceConfig(name, family, "mappings", category, url, "parquet", "json", emit=emit, package_name=package, package_version="0.1.0", package_verb="replace", options=options)


def builtin() -> list[SourceConfig]:
    """All sources; only the demo is enabled."""
    out = [
        _package("biosphere", "CuratedMappings", "02-agribalyse-3.2__ef-3.1", CURATED, "agribalyse-3.2__ef-3.1-biosphere", None, {"allowed": ["ef", "biosphere3"], "barred": "ecoinvent", "dropped": ["harmonised-flows-simple"]}),
        SourceConfig("example-csv", "DemoCsv", "inventory", "example", "bundled://example.csv", "csv", "json", enabled=True),
    ]
    for category, cls in (("products", "Product"), ("organisms", "Organism"), ("qualifiers", "Qualifier")):
        out.append(_vocab(f"foodex2-{category}", "Food", category, FOOD_URL, "ecf", category, cls, category.removesuffix("s"), check=category == "products"))
    out += [
        _provenance("foodex2-source", None, "foodex2", "FoodEx2", "Food classification catalogue MTX 17.1", ["European Food Safety Authority"], "European Food Safety Authority", FOOD_URL),
        _vocab("agribalyse-products", "Products", "products", SHEET, "parquet", "products", "Product", "product", check=True),
        _provenance("agribalyse-source", None, "agribalyse-3.2", "Agribalyse 3.2", "Agribalyse 3.2 reference table", ["ADEME"], "ADEME", "agribalyse-3.2"),
        _vocab("agribalyse-processes", "SheetProcesses", "processes", SHEET, "parquet", "processes", "Process", "process"),
        _vocab("ef-lcia-method", "EfMethodTerm", "lcia-methods", FACTORS, "parquet", "lcia_methods", "LCIAMethod", "lcia-method", "yaml"),
        _vocab("ef-impact-categories", "EfImpactTerms", "impact-categories", FACTORS, "parquet", "impact_categories", "ImpactCategory", "impact-category", "yaml"),
        SourceConfig("methods", "EfMethods", "methods", "01-ef-3.1", FACTORS, "parquet", "parquet"),
        SourceConfig("characterization-factors", "EfFactors", "methods", "01-ef-3.1", FACTORS, "parquet", "parquet"),
    ]
    out += [_vocab(f"ef31-elementary-flows-{c}", "EfFlows", "elementary-flows", FLOWS, "json-gz", "flows", "ElementaryFlow", "elementary-flow", emit=c, check=True, scheme="flows") for c in EF_COMPARTMENTS]
    out += [
        _provenance("agribalyse-ef31-source", None, "ef-3.1", "EF 3.1", "Environmental Footprint reference package 3.1", ["European Commission, Joint Research Centre"], "European Commission", "ef-3.1"),
        _provenance("bafu-2026-source", "bafu-2026", "bafu-2026", "BAFU:2026", "Life Cycle Inventory database of the Swiss Federal Administration", ["Swiss Federal Office for the Environment"], "Swiss Federal Office for the Environment", "BAFU:2026"),
    ]
    slugs = {folder: folder.split("-", 1)[1] for folder in SECTORS}
    out += [_vocab(f"bafu-processes-{s}", "LciProcessTerms", "processes", LCI, "zip", "processes", "Process", "process", emit=s) for s in slugs.values()]
    out += [_vocab(f"bafu-elementary-flows-{c}", "LciFlowTerms", "elementary-flows", LCI, "zip", "flows", "ElementaryFlow", "elementary-flow", emit=c, check=True, scheme="flows") for c in LCI_COMPARTMENTS]
    for folder, s in slugs.items():
        for kind, family in (("processes", "LciProcesses"), ("exchanges", "LciExchanges")):
            out.append(SourceConfig(f"bafu-{s}-{kind}", family, "inventory", folder, LCI, "zip", "parquet", emit=kind))
    note = "the EF flow is characterised in impact categories beyond those this flow currently receives"
    out.append(_package("bafu-ef-biosphere", "DebridgedMappings", "03-bafu-2026-v1__ef-3.1", DEBRIDGED, "bafu-2026-v1__ef-3.1-biosphere", "biosphere", {"notes": {"T3": note}}))
    return out


def load(path: Path) -> list[SourceConfig]:
    """Sources of a YAML file: a list ``sources`` of mappings with the fields of :class:`SourceConfig`."""
    doc = yaml.safe_load(path.read_text("utf-8")) or {}
    known = {f.name for f in fields(SourceConfig)}
    out = []
    for entry in doc.get("sources") or []:
        try:
            if set(entry) - known:
                raise TypeError(f"unknown fields {sorted(set(entry) - known)}")
            out.append(SourceConfig(**entry))
        except TypeError as e:
            raise RegistryError(f"invalid source {entry!r}: {e}") from e
    return out


def get(name: str, configs: list[SourceConfig] | None = None) -> SourceConfig:
    for c in configs if configs is not None else builtin():
        if c.name == name:
            return c
    raise RegistryError(f"no source named {name!r}")
