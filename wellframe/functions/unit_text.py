"""Reading units of measure out of free text."""

from __future__ import annotations

import re
import unicodedata

#: Unit as written in the unit table, and the spellings that mean it (after ``plain``).
SPELLINGS = {
    "mg/L": r"mg ?/ ?l|mg l-1|mgl|mg per l|milligrams? ?(?:per|/) ?(?:liter|litre|l)",
    "ug/L": r"(?:u|mc)g ?/ ?l|(?:u|mc)g l-1|ugl|ug per l|micrograms? ?(?:per|/) ?(?:liter|litre|l)",
    "ppm": r"ppm|parts per million",
    "ppb": r"ppb|parts per billion",
    "mg/kg": r"mg ?/ ?kg|mg per kg|mg kg-1|milligrams? per kilogram",
    "uS/cm": r"us ?/ ?cm|us cm-1|us per cm|microsiemens ?(?:per|/) ?(?:cm|centimeter|centimetre)",
    "umho/cm": r"umhos? ?/ ?cm|umhos? per cm|micromhos? ?(?:per|/) ?(?:cm|centimeter|centimetre)",
    "mS/cm": r"ms ?/ ?cm|ms cm-1|ms per cm|millisiemens ?(?:per|/) ?(?:cm|centimeter|centimetre)",
    "dS/m": r"ds ?/ ?m|ds m-1|ds per m|decisiemens ?(?:per|/) ?(?:m|meter|metre)",
    "ton/ac-ft": r"tons? ?(?:per|/) ?(?:ac|acre)[- ]?(?:ft|foot|feet)",
    "tons/day": r"tons? ?(?:per|/) ?day",
    "pCi/L": r"pci ?/ ?l|pci l-1|picocuries? ?(?:per|/) ?(?:liter|litre|l)",
    "%": r"%|percent|pct",
    "ft": r"ft|feet|foot",
    "cm": r"cm|centimeters?|centimetres?",
    "in": r"in\.?|inch(?:es)?",
    "m": r"m|meters?|metres?",
}
#: The substance a concentration is expressed as.
BASES = {"N": r"n|nitrogen", "NO3": r"no3|nitrate", "CaCO3": r"caco3|calcium carbonate"}
#: The usual way to write a unit, which misspelt texts are held against.
USUAL = {
    "mg/l": "mg/L", "ug/l": "ug/L", "ppm": "ppm", "ppb": "ppb", "mg/kg": "mg/kg", "us/cm": "uS/cm", "umho/cm": "umho/cm", "umhos/cm": "umho/cm", "ms/cm": "mS/cm", "ds/m": "dS/m",
    "tons/ac-ft": "ton/ac-ft", "tons/day": "tons/day", "pci/l": "pCi/L", "percent": "%", "feet": "ft", "meters": "m", "inches": "in",
}
#: Notes that name the unit of the row's own value.
NOTES = (
    r"units? on (?:the )?sheet: *(.+)", r"(.+?) per lab bench sheet", r"lab form gives (.+)", r"field crew noted (.+?) on the card",
    r"result reported in (.+)", r"(?:value|result) keyed as (.+?)(?: *;.*)?",
)
NUMBER = re.compile(r"^\s*[<>~=]*\s*([-+]?(?:\d[\d,]*\.?\d*|\.\d+)(?:e[-+]?\d+)?)\s*(.*)$", re.I | re.S)

_BASIS = "(?:" + "|".join(f"(?P<b{k}>{v})" for k, v in BASES.items()) + ")"
_UNIT = {k: re.compile(f"(?:{v})") for k, v in SPELLINGS.items()}
_BASIS_END = re.compile(rf"\(?(?:(?<=[^a-z0-9])|-)(?:as ?|expressed as )?{_BASIS}\)?$")
_BASIS_IN = re.compile(rf"(?<![a-z0-9])as {_BASIS}(?![a-z0-9])")
_NOTES = [re.compile(n, re.S) for n in NOTES]
_LOOSE = re.compile(
    r"(?<![a-z0-9/.\-])(\d[\d.,]* ?)?(?:" + "|".join(f"(?P<u{i}>{v})" for i, (k, v) in enumerate(SPELLINGS.items()) if k not in ("in", "m", "%")) + r")(?![a-z0-9/])"
)


def plain(text: str | None) -> str:
    """Lower case, one kind of micro sign, single blanks, no footnote marks."""
    t = unicodedata.normalize("NFKC", text or "").replace("μ", "u").replace("µ", "u").lower()
    return " ".join(t.replace("*", " ").split())


def _basis(match: re.Match | None) -> str | None:
    return next((k for k in BASES if match and match.group(f"b{k}")), None)


def read_unit(text: str | None) -> tuple[str | None, str | None]:
    """(unit, basis) of a text that is a unit as a whole; (None, None) if it is none."""
    t = re.sub(r" ?@ ?25 ?(?:deg(?:rees)?)? ?c?$| at 25 ?(?:deg)? ?c$", "", plain(text))
    t = re.sub(r" (?:bgs|bls|below (?:ground|land) surface)$", "", t).strip(" .;:") if t not in ("in.",) else t
    end = _BASIS_END.search(t)
    for body, basis in ((t, None), *(((t[: end.start()].strip(" -("), _basis(end)),) if end else ())):
        for unit, pattern in _UNIT.items():
            if pattern.fullmatch(body):
                return unit, basis
    return None, None


def read_name(text: str | None) -> tuple[str | None, str | None]:
    """(unit, basis) in a parameter's name: in brackets, or after its last comma; ``as N`` anywhere."""
    t = plain(text)
    for part in [*re.findall(r"[\[(]([^\])]*)[\])]", t), *([t.rpartition(",")[2]] if "," in t else [])]:
        unit, basis = read_unit(part)
        if unit:
            return unit, basis or _basis(_BASIS_IN.search(t))
    return None, _basis(_BASIS_IN.search(t))


def read_note(text: str | None) -> tuple[str | None, str | None]:
    """(unit, basis) that a remark gives for the row's value; amounts of other things are passed over."""
    t = plain(text)
    if not t:
        return None, None
    for clause in [t, *(c.strip() for c in t.split(";"))]:
        for note in _NOTES:
            m = note.fullmatch(clause)
            unit, basis = read_unit(m.group(1)) if m else (None, None)
            if unit:
                return unit, basis or _basis(_BASIS_IN.search(t))
    for m in _LOOSE.finditer(t):
        if not m.group(1):
            found = next(k for i, k in enumerate(SPELLINGS) if m.groupdict().get(f"u{i}"))
            return found, _basis(_BASIS_IN.search(t))
    return None, _basis(_BASIS_IN.search(t))


def read_value(text: str | None) -> tuple[float | None, str | None, str | None]:
    """(number, unit, basis) of a value as received; unreadable parts are None."""
    m = NUMBER.match(text or "")
    if not m:
        return None, None, None
    unit, basis = read_unit(m.group(2)) if m.group(2) else (None, None)
    try:
        number = float(m.group(1).replace(",", ""))
    except ValueError:
        number = None
    return number if not m.group(2) or unit else None, unit, basis


def near_units(text: str | None) -> list[str]:
    """Units whose usual spelling is one letter put in, left out, changed or swapped away from an unreadable text."""
    t = plain(text)
    if len(t) < 3:
        return []

    def one_away(a: str, b: str) -> bool:
        if abs(len(a) - len(b)) > 1:
            return False
        head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        rest_a, rest_b = a[head:], b[head:]
        return rest_a[1:] == rest_b[1:] or rest_a[1:] == rest_b or rest_a == rest_b[1:] or (rest_a[:2] == rest_b[1::-1] and rest_a[2:] == rest_b[2:])

    return sorted({unit for usual, unit in USUAL.items() if one_away(t, usual)})
