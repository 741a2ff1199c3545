"""Reading unit spellings: multiplier, base spelling and what the words suggest.

Everything here works on distinct spellings, not on rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

#: Words and signs for powers of ten before a unit.
MULTIPLIER_WORDS = {
    "hundred": 1e2, "hundert": 1e2, "cent": 1e2,
    "thousand": 1e3, "tausend": 1e3, "tsd": 1e3, "mille": 1e3,
    "million": 1e6, "millions": 1e6, "mio": 1e6, "mill": 1e6, "millionen": 1e6,
    "billion": 1e9, "mrd": 1e9, "milliarden": 1e9, "milliard": 1e9,
}

#: Other words for the units of the table, by unit code; case, spaces and signs do not count.
WORDS = {
    "kg": ["kgs", "kilo", "kilos", "kilogramm", "kilogramme", "kilogrammes", "kilograms"],
    "g": ["gr", "gramm", "gramme", "grammes", "grams"],
    "mg": ["milligramm", "milligramme", "milligrams"],
    "ug": ["mcg", "mikrogramm", "microgramme", "micrograms"],
    "t": ["to", "ton", "tons", "tonnen", "metric ton", "metric tons", "megagram", "megagramm"],
    "kt": ["kilotonnen", "kiloton", "kilotons", "gigagram"],
    "lb": ["lbs", "pfund", "livre", "livres"],
    "m3": ["cbm", "cubic meter", "kubikmeter", "metre cube", "metres cubes", "cum"],
    "l": ["ltr", "liter", "dm3", "cubic decimetre", "kubikdezimeter", "litres"],
    "hl": ["hektoliter", "hectoliter"],
    "ml": ["milliliter"],
    "cm3": ["ccm", "cc", "cubic centimeter", "kubikzentimeter", "centimetre cube"],
    "m": ["meter", "metres"],
    "km": ["kilometer"],
    "cm": ["centimeter", "zentimeter"],
    "mi": ["miles", "meile", "meilen"],
    "m2": ["sqm", "qm", "sq m", "square meter", "quadratmeter", "metre carre", "metres carres"],
    "ha": ["hektar", "hectares"],
    "km2": ["sq km", "sqkm", "square kilometer", "quadratkilometer", "kilometre carre"],
    "cm2": ["sq cm", "sqcm", "square centimeter", "quadratzentimeter"],
    "tkm": ["ton km", "ton kilometer", "tonnenkilometer", "tonne kilometer", "metric ton km", "tonnes kilometre"],
    "kgkm": ["kilogramm kilometer", "kilogram kilometer"],
    "m2a": ["m2 year", "m2 yr", "m2 jahr", "m2 an", "sqm year", "square meter year", "quadratmeterjahr"],
    "haa": ["ha year", "ha yr", "hectare a", "hektarjahr"],
    "h": ["hr", "hrs", "std", "stunde", "stunden", "heure", "heures"],
    "min": ["mins", "minuten"],
    "d": ["tag", "tage", "jour", "jours"],
    "Wh": ["wattstunde", "wattstunden", "wattheure"],
    "kWh": ["kilowattstunde", "kilowattstunden", "kilowattheure", "kilo watt hour"],
    "MWh": ["megawattstunde", "megawattstunden", "megawattheure"],
    "kcal": ["kilokalorie", "kilokalorien"],
    "unit": ["p", "pc", "pcs", "pce", "piece", "item", "items", "ea", "each", "stuck", "stueck", "stk", "st", "unite", "einheit", "unidad"],
    "doz": ["dz", "dutzend", "douzaine"],
}

#: Spellings whose meaning hangs on their case.
CASED = {"Mg": "t", "Gg": "kt"}

_SUPER = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻", "0123456789-")
_NUMBER = re.compile(r"(?P<n>\d{1,3}(?:['’,\s]\d{3})+|\d+(?:\.\d+)?)(?:[eE](?P<e>[+-]?\d+))?\s*(?:[x×*·]\s*)?(?P<rest>[^\d\s].*)$")
_TEN = re.compile(r"10(?:\^|\*\*)(?P<e>[+-]?\d+)\s*(?P<rest>\D.*)$")
_TEN_UP = re.compile(r"10(?P<e>[⁰¹²³⁴⁵⁶⁷⁸⁹⁻]+)\s*(?P<rest>.+)$")


#: Encodings in which UTF-8 text is read by mistake.
CODECS = ["cp1252", "latin-1", "cp1250", "cp437", "cp850", "mac_roman", "cp1251"]


def repair(text: str, codecs: Iterable[str] = tuple(CODECS)) -> str:
    """Up to three readings of wrongly decoded text as the UTF-8 it was."""
    for _ in range(3):
        if text.isascii():
            return text
        for codec in codecs:
            try:
                better = text.encode(codec).decode("utf-8")
                break
            except UnicodeError:
                better = None
        if better is None or better == text:
            return text
        text = better
    return text


def split_multiplier(text: str) -> tuple[float, str]:
    """(multiplier, spelling without it): ``10^3 kg`` is (1000.0, ``kg``)."""
    s = " ".join(repair(text).split())
    for pattern in (_TEN_UP, _TEN):
        if m := pattern.match(s):
            return 10.0 ** int(m["e"].translate(_SUPER)), m["rest"].strip()
    if m := _NUMBER.match(s):
        n = float(re.sub(r"['’,\s]", "", m["n"]))
        return float(f"{n:g}e{m['e']}") if m["e"] else n, m["rest"].strip()
    first, _, rest = s.partition(" ")
    if rest and (n := MULTIPLIER_WORDS.get(first.lower().rstrip("."))):
        return n, rest.strip()
    return 1.0, s


def compact(spelling: str) -> str:
    """Letters and digits only: no case, accents, signs or spaces; empty if a character is lost or strange."""
    s = unicodedata.normalize("NFKD", spelling.replace("µ", "u").replace("μ", "u"))
    s = "".join(c for c in s.lower() if not unicodedata.combining(c))
    if re.search(r"[^\x00-\x7f·×⋅∙\u2010-\u2015]|\?", s):
        return ""
    return re.sub(r"[^a-z0-9]", "", s)


def lexicon(units: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    """compact form -> unit codes it may stand for, from (unit_code, unit_name) rows and ``WORDS``."""
    out: dict[str, list[str]] = {}
    for code, name in units:
        forms = [code, name, *WORDS.get(code, [])]
        forms += [f + "s" for f in [name, *WORDS.get(code, [])]]
        forms += [f.replace("metre", "meter").replace("litre", "liter") for f in forms]
        for f in forms:
            codes = out.setdefault(compact(f), [])
            if code not in codes:
                codes.append(code)
    return out


def suggested(base: str, words: dict[str, list[str]], codes: set[str]) -> list[str]:
    """Unit codes a base spelling may stand for: the exact code, a cased spelling, or its words."""
    s = base.strip().rstrip(".").strip()
    if s in codes:
        return [s]
    if s in CASED and CASED[s] in codes:
        return [CASED[s]]
    found = words.get(compact(s), []) if compact(s) else []
    if not found:
        found = words.get(compact(re.sub(r"\(.*?\)", "", s)), [])
    return found
