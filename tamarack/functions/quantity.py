"""Numbers, scales and units written as text.

Values are read a column at a time in Arrow's own kernels (no Python code per row); the
unit tables are fixed by this module.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Physical units. dimension -> canonical unit -> (size in the dimension's base unit, spellings)
UNITS: dict[str, dict[str, tuple[float, tuple[str, ...]]]] = {
    "length": {
        "m": (1.0, ("m", "metre", "metres", "meter", "meters", "metro", "metros", "mts", "mt")),
        "cm": (0.01, ("cm", "centimetre", "centimetres", "centimeter", "centimeters", "centímetros")),
        "mm": (0.001, ("mm", "millimetre", "millimetres", "millimeter", "millimeters", "milímetros", "milimetros")),
        "ft": (0.3048, ("ft", "feet", "foot", "pies", "pie", "ft-in", "′", "'")),
        "in": (0.0254, ("in", "inch", "inches", "pulg", "pulgadas", "″", '"')),
    },
    "mass": {
        "ton": (1000.0, ("ton", "tons", "tonne", "tonnes", "t", "metric ton", "metric tons", "tonelada", "toneladas", "mt")),
        "kg": (1.0, ("kg", "kgs", "kilo", "kilos", "kilogram", "kilograms", "kilogramos")),
        "lb": (0.45359237, ("lb", "lbs", "pound", "pounds", "libra", "libras")),
        "short ton": (907.18474, ("short ton", "short tons", "us ton", "us tons", "sh tn", "st")),
    },
    "power": {
        "kW": (1.0, ("kw", "kilowatt", "kilowatts", "kilovatios")),
        "MW": (1000.0, ("mw", "megawatt", "megawatts")),
        "hp": (0.74569987158227022, ("hp", "bhp", "h.p.", "h.p", "horsepower")),
        "PS": (0.73549875, ("ps", "cv", "metric hp")),
    },
    "volume": {
        "m3": (1.0, ("m3", "m³", "cu m", "cbm", "m^3", "cubic metres", "cubic meters")),
        "L": (0.001, ("l", "litre", "litres", "liter", "liters", "litro", "litros")),
        "yd3": (0.764554857984, ("yd3", "yd³", "cu yd", "cy", "cubic yards", "yd^3")),
        "gal": (0.003785411784, ("gal", "gallon", "gallons", "us gal", "galón", "galones", "us gallons")),
        "imp gal": (0.00454609, ("imp gal", "imperial gallons", "uk gal")),
        "cc": (1e-6, ("cc", "cm3", "cm³", "cubic centimetres")),
        "in3": (1.6387064e-5, ("in3", "in³", "cu in", "cid", "cubic inches")),
    },
    "torque": {
        "Nm": (1.0, ("nm", "n m", "n.m", "n·m", "n-m", "newton metres")),
        "kNm": (1000.0, ("knm", "kn m", "kn.m", "kn·m", "kn-m")),
        "lb-ft": (1.3558179483314004, ("lb-ft", "lb ft", "lbf·ft", "lbf-ft", "lbf.ft", "ft-lb", "ft lb", "lbf ft", "ft·lb")),
    },
    "force": {
        "kN": (1.0, ("kn", "kilonewton", "kilonewtons")),
        "N": (0.001, ("n", "newton", "newtons")),
        "MN": (1000.0, ("mn", "meganewton", "meganewtons")),
        "kgf": (0.00980665, ("kgf", "kg-f", "kp", "kilopond", "kg", "kgs")),
        "lbf": (0.0044482216152605, ("lbf", "lb-f", "lb", "lbs", "pound-force")),
        "tf": (9.80665, ("tf", "ton-f", "tonf", "ton force", "t-f")),
    },
    "pressure": {
        "bar": (1.0, ("bar", "bars", "bares")),
        "psi": (0.0689475729316836, ("psi", "lb/in2", "lb/in²", "lbf/in2")),
        "MPa": (10.0, ("mpa", "megapascals")),
        "kPa": (0.01, ("kpa", "kilopascals")),
        "kgf/cm2": (0.980665, ("kg/cm2", "kg/cm²", "kgf/cm2", "kgf/cm²")),
    },
    "speed": {
        "km/h": (1.0, ("km/h", "kmh", "kph", "km/hr", "kmph")),
        "mph": (1.609344, ("mph", "mi/h", "miles/h")),
        "m/s": (3.6, ("m/s", "m/sec")),
    },
    "flow per hour": {
        "L/h": (1.0, ("l/h", "lph", "litros/hora", "litres/hour", "l/hr")),
        "gal/h": (3.785411784, ("gal/h", "gph", "us gal/h", "gal/hr")),
    },
    "flow per minute": {
        "L/min": (1.0, ("l/min", "lpm", "litros/min", "litres/min")),
        "gal/min": (3.785411784, ("gal/min", "gpm", "us gpm")),
        "m3/h": (16.666666666666668, ("m3/h", "m³/h", "m3/hr")),
    },
    "rotation": {
        "rpm": (1.0, ("rpm", "r/min", "min-1", "min⁻¹", "rev/min")),
        "deg/s": (1 / 6, ("deg/s", "°/s", "degrees/s")),
    },
    "slope": {
        "%": (1.0, ("%", "percent", "pct", "por ciento", "prozent", "pour cent")),
        "deg": (float("nan"), ("°", "deg", "degree", "degrees", "grado", "grados")),
    },
    "voltage": {
        "V": (1.0, ("v", "volt", "volts", "vdc", "voltios")),
        "kV": (1000.0, ("kv", "kilovolts")),
    },
}
# Stand-ins for a missing value (lower case), and scale words.
PLACEHOLDERS = ("", "0", "-", "--", "---", "n/a", "na", "n.a.", "n.d.", "nd", "tbd", "tba", "null", "none", "nil", "?", "..", "...", "***", "*", "not available", "unknown", "contact dealer", "consultar", "consult", "según configuración")
SCALES = {"thousand": 1e3, "mil": 1e3, "tausend": 1e3, "mille": 1e3, "k": 1e3, "million": 1e6, "millones": 1e6, "millionen": 1e6, "millions": 1e6}
NO_UNIT = ("", "-", "--", "n/a", "na", "none", "null", "?")

_NUM = r"\d{1,3}(?: \d{3})+(?:[.,]\d+)?|\d+(?:[.,]\d+)*(?:e[+-]?\d+)?"
_QUANTITY = rf"^[^\d]*(?P<num>{_NUM})\.?(?:\s*[-–—]\s*(?:{_NUM}))?\s*(?:(?P<scale>thousand|millionen|millions|million|millones|mille|mil|tausend)(?: +|$))?\s*(?P<unit>[^(]*)"
_FEET_INCHES = r"^[^\d]*(?P<ft>\d+)\s*(?:-?\s*ft|'|′)\s*-?\s*(?P<in>\d+(?:\.\d+)?)\s*(?:-?\s*in\b|\"|″)"
_ODD_SPACES = r"[\x{00a0}\x{2002}\x{2003}\x{2007}\x{2009}\x{202f}\t\r\n]"

DIMENSIONS = list(UNITS)
#: Most units in one dimension, and one state more for "a thousand times the common unit".
STATES = max(len(u) for u in UNITS.values()) + 1


def canonical(unit: str) -> tuple[str, str] | None:
    """(dimension, canonical unit) of a catalogue unit; None if unknown."""
    for dim, units in UNITS.items():
        for canon, (_, spellings) in units.items():
            if unit == canon or unit.strip().lower() in spellings:
                return dim, canon
    return None


@functools.cache
def states(common: str) -> tuple[tuple[str, ...], tuple[float, ...]]:
    """The unit states of a common unit, itself first, with their factors to it (NaN: not linear)."""
    dim, canon = canonical(common)
    units = UNITS[dim]
    names = (canon, *(u for u in units if u != canon))
    return (*names, f"1000 {canon}"), (*(units[u][0] / units[canon][0] for u in names), 1000.0)


@functools.cache
def _spellings() -> tuple[pa.Array, np.ndarray]:
    """Keys "dimension number|spelling" and the unit's place in its dimension."""
    keys, place = [], []
    for d, units in enumerate(UNITS.values()):
        for i, (canon, (_, spellings)) in enumerate(units.items()):
            for s in dict.fromkeys((*spellings, canon.lower())):
                keys.append(f"{d}|{s}")
                place.append(i)
    return pa.array(keys), np.array(place)


def clean(text: pa.Array) -> pa.Array:
    """Lower case, usual spaces, no space at the ends."""
    t = pc.replace_substring_regex(pc.utf8_lower(text), _ODD_SPACES, " ")
    return pc.utf8_trim(pc.replace_substring_regex(t, " {2,}", " "), " ")


def is_missing(cleaned: pa.Array) -> pa.Array:
    """True for null, blank and stand-ins for a missing value."""
    known = pc.is_in(cleaned, value_set=pa.array(PLACEHOLDERS))
    shape = pc.match_substring_regex(cleaned, r"^(?:[-–—*.?_\s]*|0+(?:[.,]0+)?)$")
    return pc.fill_null(pc.or_(known, shape), True)


def _double(text: pa.Array) -> pa.Array:
    return pc.cast(pc.if_else(pc.match_substring_regex(text, r"^\d+(?:\.\d+)?(?:e[+-]?\d+)?$"), text, None), pa.float64())


def readings(token: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The two ways to read a number token: the usual one, and the other one where a single separator leaves it open (else null)."""
    t = pc.replace_substring(token, " ", "")
    dots, commas = pc.count_substring(t, "."), pc.count_substring(t, ",")
    no_commas, no_dots = pc.replace_substring(t, ",", ""), pc.replace_substring(t, ".", "")
    point = pc.replace_substring(no_dots, ",", ".")
    both = pc.and_(pc.greater(dots, 0), pc.greater(commas, 0))
    last_dot = pc.match_substring_regex(t, r",.*\.[^,]*$")
    three = pc.match_substring_regex(t, r"^[1-9]\d{0,2}[.,]\d{3}$")
    one_comma = pc.equal(commas, 1)
    usual = pc.if_else(
        both,
        pc.if_else(last_dot, no_commas, point),
        pc.if_else(pc.or_(pc.greater(commas, 1), pc.and_(one_comma, three)), no_commas, pc.if_else(pc.greater(dots, 1), no_dots, pc.if_else(one_comma, point, t))),
    )
    other = pc.if_else(three, pc.if_else(one_comma, point, no_dots), None)
    return _double(usual), _double(other)


def _group(found: pa.Array, name: str) -> pa.Array:
    return pc.struct_field(found, name)


def _np(a: pa.Array) -> np.ndarray:
    return a.to_numpy(zero_copy_only=False)


def unit_place(dim: np.ndarray, text: pa.Array) -> np.ndarray:
    """The place of each unit text among its dimension's units; -1 where unknown."""
    keys, place = _spellings()
    at = pc.index_in(pc.binary_join_element_wise(pc.cast(pa.array(dim), pa.string()), text, "|"), value_set=keys)
    return np.where(_np(pc.is_valid(at)), place[_np(pc.fill_null(at, 0))], -1)


def _to_common(x: np.ndarray, factor: np.ndarray, slope_deg: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.where(slope_deg, np.tan(np.radians(x)) * 100, x * factor)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """base[d, place]: a unit's size in its dimension's base unit; state[d, common, place]: its state's number, the common unit being 0."""
    most = STATES - 1
    base = np.full((len(UNITS), most), np.nan)
    state = np.full((len(UNITS), most, most), -1, np.int64)
    for d, units in enumerate(UNITS.values()):
        for i, (size, _) in enumerate(units.values()):
            base[d, i] = size
            order = [i, *(j for j in range(len(units)) if j != i)]
            for k, j in enumerate(order):
                state[d, i, j] = k
    return base, state


def read(value: pa.Array, unit: pa.Array, hint: pa.Array, dim: np.ndarray, common: np.ndarray, low: np.ndarray, high: np.ndarray, bare_is_common: bool, mixed: bool = True) -> dict[str, pa.Array]:
    """Read the first quantity of each value.

    dim and common number a parameter's dimension and its common unit's place in it, -1 for
    parameters without one. A unit in the value goes before ``unit``. Returns missing,
    alone (the whole value is one number), number, scale, idx (the state of the unit: 0 the
    common unit, null where it needs decoding), hint_idx, and home (in the common unit where
    idx is known). A bare number is in the common unit if it lies in the band, or always
    with bare_is_common. Where a comma may be a decimal or a thousands mark, the usual
    reading counts unless only the other one falls in the band; without ``mixed`` always
    (sources that write numbers in one style only, where the other reading would bring
    gross errors back into the band).
    """
    c = clean(value)
    missing = _np(is_missing(c))
    has = dim >= 0
    d, k = np.where(has, dim, 0), np.where(has, common, 0)
    found = pc.extract_regex(c, _QUANTITY)
    usual_a, other_a = readings(_group(found, "num"))
    usual, other = _np(pc.fill_null(usual_a, float("nan"))).astype(float), _np(pc.fill_null(other_a, float("nan"))).astype(float)
    feet = pc.extract_regex(c, _FEET_INCHES)
    composite = _np(pc.is_valid(feet))
    ft = _np(pc.fill_null(_double(_group(feet, "ft")), 0.0)) + _np(pc.fill_null(_double(_group(feet, "in")), 0.0)) / 12
    usual = np.where(composite, ft, usual)
    word = pc.fill_null(_group(found, "scale"), "")
    scale = np.ones(len(c))
    for w, f in SCALES.items():
        if len(w) > 2:
            scale[_np(pc.equal(word, w))] = f
    text = pc.utf8_trim(pc.fill_null(_group(found, "unit"), ""), " ")
    plain = pc.utf8_rtrim(text, characters=".;, ")
    own = np.maximum(unit_place(dim, text), unit_place(dim, plain))
    own = np.where(composite, unit_place(dim, pa.array(["ft"] * len(c))), own)
    column = unit_place(dim, pc.fill_null(clean(unit), ""))
    stated = np.where(own >= 0, own, column)
    base, state = _tables()
    at = np.where(stated >= 0, stated, k)
    factor = base[d, at] / base[d, k]
    slope = (np.array(DIMENSIONS)[d] == "slope") & (at != k)
    conv = lambda x: _to_common(x * scale, factor, slope)
    inside = lambda v: (v >= low) & (v <= high)
    with np.errstate(invalid="ignore"):
        number = np.where(mixed & ~np.isnan(other) & ~inside(conv(usual)) & inside(conv(other)), other, usual)
        number = np.where(missing, np.nan, number)
        at_home = np.ones(len(c), bool) if bare_is_common else inside(number * scale)
        idx = np.where(stated >= 0, state[d, k, at], np.where(at_home, 0, -1))
        known = has & ~np.isnan(number) & (idx >= 0)
        home = np.where(known, conv(number), np.nan)
    hinted = unit_place(dim, pc.fill_null(clean(hint), ""))
    hint_idx = np.where(has & (hinted >= 0), state[d, k, np.maximum(hinted, 0)], -1)
    null = lambda a, t, ok: pa.array(a.astype(t), mask=~ok)
    return {
        "missing": pa.array(missing),
        "alone": pc.fill_null(pc.match_substring_regex(c, r"^\d[\d.,]*$"), False),
        "number": null(number, float, ~np.isnan(number)),
        "scale": pa.array(scale),
        "idx": null(idx, np.int8, known),
        "hint_idx": null(hint_idx, np.int8, hint_idx >= 0),
        "home": null(home, float, known & ~np.isnan(home)),
    }


READ_FIELDS = "missing boolean, alone boolean, number double, scale double, idx tinyint, hint_idx tinyint, home double"
