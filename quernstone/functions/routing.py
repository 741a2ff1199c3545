"""Where a row belongs: categories, sectors, compartments, types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.keys import stripped

#: Term type -> category; other types are products.
TERM_CATEGORY = {"n": "organisms", "r": "products", "d": "products", "s": "products", "c": "products", "g": "products", "f": "qualifiers"}
#: Delivered status -> published status; others have none.
STATUS = {"APPROVED": "draft", "PRELIMINARY": "draft", "DEPRECATED": "deprecated"}
#: Attribute codes of legacy identifiers and their prefixes.
LEGACY_CODES = [("foodexOldCode", "foodex1"), ("GEMSCode", "gems"), ("matrixCode", "matrix")]
#: Sector folder -> categories of the inventory.
SECTORS = {
    "01-agriculture": ["agricultural", "food industry"],
    "02-electricity": ["electricity", "electricity by fuel", "photovoltaic", "wind power", "power plants", "impoundment"],
    "03-chemicals": ["chemicals"],
    "04-transport": ["transport systems"],
    "05-energy": ["natural gas", "heat", "fuels", "oil", "heating", "heat pumps", "biomass", "compressed air", "pipeline", "energy supply, kbob recommendation"],
    "06-waste": ["waste management", "landfill", "construction waste", "electronics waste", "wastewater treatment", "waste", "transport waste", "incineration", "nuclear waste", "underground deposit", "recycling", "landfarming"],
    "07-construction": ["construction materials", "construction", "construction processes", "building components", "building processes", "flooring", "insulation materials", "ceramics"],
    "08-materials": ["wood", "metals", "minerals", "paper+ board", "plastics", "glass", "textiles", "cardboard"],
    "09-electronics": ["electronics", "computers & network", "mechanical"],
    "10-building-services": ["ventilation", "water", "private consumption", "Others"],
    "99-obsolete": ["material, obsolete", "energy, obsolete", "processing, obsolete", "waste treatment, obsolete"],
}
#: Sector folder -> title.
SECTOR_TITLES = {
    "01-agriculture": "Agriculture",
    "02-electricity": "Electricity",
    "03-chemicals": "Chemicals",
    "04-transport": "Transport",
    "05-energy": "Energy",
    "06-waste": "Waste management",
    "07-construction": "Construction",
    "08-materials": "Materials",
    "09-electronics": "Electronics",
    "10-building-services": "Building services",
    "99-obsolete": "Obsolete (BAFU legacy link targets)",
}
#: Parts of a context identifier -> compartment.
DOMAIN_COMPARTMENT = {"reso": "natural resource", "laus": "land use"}
MEDIUM_COMPARTMENT = {"air": "air", "wate": "water", "grou": "soil", "biot": "biota"}
#: Impact category -> reference unit.
IMPACT_UNITS = {
    "Acidification": "mol H+ eq",
    "Climate change": "kg CO2 eq",
    "Climate change-Biogenic": "kg CO2 eq",
    "Climate change-Fossil": "kg CO2 eq",
    "Climate change-Land use and land use change": "kg CO2 eq",
    "EF-particulate Matter": "disease incidence",
    "Eutrophication marine": "kg N eq",
    "Eutrophication, freshwater": "kg P eq",
    "Eutrophication, terrestrial": "mol N eq",
    "Human toxicity, cancer": "CTUh",
    "Human toxicity, cancer_inorganics": "CTUh",
    "Human toxicity, cancer_organics": "CTUh",
    "Human toxicity, non-cancer": "CTUh",
    "Human toxicity, non-cancer_inorganics": "CTUh",
    "Human toxicity, non-cancer_organics": "CTUh",
    "Ionising radiation, human health": "kBq U-235 eq",
    "Land use": "Pt",
    "Ozone depletion": "kg CFC-11 eq",
    "Photochemical ozone formation - human health": "kg NMVOC eq",
    "Resource use, fossils": "MJ",
    "Resource use, minerals and metals": "kg Sb eq",
    "Water use": "m3 world eq deprived",
    "Ecotoxicity, freshwater": "CTUe",
    "Ecotoxicity, freshwater_inorganics": "CTUe",
    "Ecotoxicity, freshwater_organics": "CTUe",
}


def lookup(table: Mapping[str, str], c: Column) -> Column:
    """The table's value for a key, null for other keys."""
    literal = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.try_element_at(literal, c)


def term_category(term_type: Column) -> Column:
    """Category by the first element of the type list; unknown or absent types are products."""
    first = F.try_element_at(term_type, F.lit(1))
    return F.coalesce(F.when(first.isNotNull(), lookup(TERM_CATEGORY, first)), F.lit("products"))


def status(c: Column) -> Column:
    return lookup(STATUS, F.upper(stripped(c)))


def sector(category: Column) -> Column:
    """Sector folder of a category; an unknown category stops the query."""
    table = {c: s for s, cs in SECTORS.items() for c in cs}
    found = lookup(table, category)
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("category not in the sector map: "), F.coalesce(category, F.lit("null")))))


def sector_slug(folder: Column) -> Column:
    """The folder without its rank."""
    return F.regexp_replace(folder, "^[^-]*-", "")


def context_segment(iri: Column) -> Column:
    """Last path segment of a context identifier; null for other identifiers."""
    last = F.element_at(F.split(F.rtrim(iri, F.lit("/")), "/"), -1)
    return F.when(F.contains(iri, F.lit("/flow-contexts/")), last)


def context_compartment(iri: Column) -> Column:
    """Compartment of a context identifier, null where it has none."""
    parts = F.split(context_segment(iri), "-")
    domain, medium = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    return F.coalesce(lookup(DOMAIN_COMPARTMENT, domain), F.when((domain == "envi") & medium.isNotNull(), lookup(MEDIUM_COMPARTMENT, medium)))


def flow_type(group: Column, code: Column) -> Column:
    """production for output 0, biosphere for code 4, else technosphere."""
    return F.when((group == "output") & (code == 0), "production").when(code == 4, "biosphere").otherwise("technosphere")


def obsolete(name: Column, category: Column, subcategory: Column) -> Column:
    empty = lambda c: F.coalesce(c, F.lit(""))
    return F.startswith(empty(name), F.lit("xx")) | F.contains(empty(category), F.lit("obsolete")) | F.contains(empty(subcategory), F.lit("notMaintained"))


def reference_unit(impact: Column) -> Column:
    """Reference unit of an impact category, ``''`` for others."""
    return F.coalesce(lookup(IMPACT_UNITS, impact), F.lit(""))


def shippable(target_db: Column, provenance: Column, allowed: list[str], barred_part: str, dropped: list[str]) -> Column:
    """Rows of an allowed database whose provenance neither contains the barred part nor is dropped; null provenance is ``''``."""
    p = F.coalesce(provenance, F.lit(""))
    return F.coalesce(target_db.isin(allowed), F.lit(False)) & ~F.contains(p, F.lit(barred_part)) & ~p.isin(dropped)


def real_factor(c: Column) -> Column:
    """A conversion factor unless it is 1 or null; NaN stays."""
    return F.when(c.isNotNull() & (c != 1.0), c)
