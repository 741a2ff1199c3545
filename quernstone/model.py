"""Declarations: sources, targets, run options, output contracts."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from quernstone.errors import RegistryError

_S, _A, _D = "string", "array<string>", "double"
#: Output contracts, as DDL.
CONTRACTS = {
    "concept": f"iri {_S}, pref_label {_S}, alt_labels {_A}, definition {_S}, notation {_S}, additional_notations {_A}, broader {_S}, related {_A}, source {_S}, status {_S}",
    "flow": f"iri {_S}, pref_label {_S}, alt_labels {_A}, definition {_S}, compartment {_S}, sub_compartment {_S}, cas_number {_S}, formula {_S}, notation {_S}, additional_notations {_A}, exact_match {_A}, source {_S}, status {_S}",
    "process_term": f"iri {_S}, pref_label {_S}, notation {_S}, process_type {_S}, definition {_S}, related {_A}, additional_notations {_A}, alt_labels {_A}, source {_S}, status {_S}",
    "process": f"process_id {_S}, name {_S}, reference_product {_S}, reference_unit {_S}, reference_amount {_D}, location {_S}, process_type {_S}, technology {_S}, comment {_S}",
    "exchange": f"process_id {_S}, flow {_S}, flow_name {_S}, flow_type {_S}, direction {_S}, amount {_D}, unit {_S}, location {_S}, uncertainty_type bigint, loc {_D}, scale {_D}, minimum {_D}, maximum {_D}",
    "method": f"method_id {_S}, method_name {_S}, impact_category {_S}, unit {_S}, methodology {_S}, source {_S}, datasource {_S}",
    "factor": f"method_id {_S}, impact_category {_S}, flow {_S}, flow_name {_S}, factor_value {_D}, unit {_S}, flow_context {_S}, location {_S}",
}


@dataclass(frozen=True)
class SourceConfig:
    """One source as the registry declares it."""

    name: str
    family: str
    target: str
    category: str
    url: str
    format: str
    output: str
    item_class: str | None = None
    enabled: bool = False
    emit: str | None = None  # file name without extension; the source's name if unset
    collection: str | None = None
    items_key: str | None = None
    scheme: str | None = None
    schema_file: str | None = None
    on_existing: str = "skip"
    check_existing: bool = True
    package_name: str | None = None
    package_version: str | None = None
    package_verb: str | None = None
    options: dict = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Target:
    """Where a kind of data goes."""

    name: str
    repo: str
    output_subdir: str = "data"
    schema_ref: str | None = None
    validator: str = "none"


TARGETS = {
    "vocab": Target("vocab", "https://git.example/vocab.git", schema_ref="main", validator="schema"),
    "inventory": Target("inventory", "https://git.example/inventory.git"),
    "methods": Target("methods", "https://git.example/methods.git"),
    "mappings": Target("mappings", "https://git.example/mappings.git"),
}


def target(name: str) -> Target:
    try:
        return TARGETS[name]
    except KeyError:
        raise RegistryError(f"no target named {name!r}") from None


@dataclass(frozen=True)
class RunContext:
    """Options of one run. ``existing_root`` holds the published collections, one folder a category."""

    cache_dir: Path = Path(".cache")
    output_dir: Path = Path("out")
    dry_run: bool = True
    offline: bool = False
    schema_dir: Path | None = None
    existing_root: Path | None = None
    deliver_root: Path | None = None
