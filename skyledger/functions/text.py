"""Text fields of observation records as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of object types and of observation methods.
OBJECT_TYPES = {
    "A1": "planet", "A2": "Moon", "A3": "Sun", "A4": "asteroid", "A5": "comet", "A6": "meteor", "A7": "artificial satellite",
    "S1": "star", "S2": "double star or multiple star", "S3": "variable star", "S4": "star cluster", "S5": "HII region", "S6": "nebula",
    "S7": "planetary nebula", "S8": "supernova + SN remnants", "S9": "fundamental star", "SR": "reference star around a radio source",
    "SA": "stellar association", "SD": "dark nebula", "SH": "Herbig-Haro object", "SM": "molecular cloud", "SP": "pulsar",
    "G1": "galaxy", "G2": "QSO", "G3": "group of galaxies", "G4": "cluster of galaxies", "G5": "supercluster", "G6": "void", "F": "field",
    "G7": "radio galaxy", "GR": "gamma-ray source", "XR": "X-ray source", "RS": "radio source", "IR": "infrared source", "U": "object of unknown nature",
}
METHODS = {
    1: "direct photograph", 2: "direct photograph, multi-exposure", 3: "stellar tracks", 4: "objective prism", 5: "objective prism, multi-exposure",
    6: "Metcalf's method", 7: "proper motions", 8: "no guiding", 9: "out of focus", 10: "test plate", 11: "Hartmann test", 12: "with mask",
    14: "sub-beam (Pickering) prism", 13: "focusing", 15: "raster scan/trail", 24: "objective grating", 25: "objective grating, multi-exposure",
    31: "objective prism together with a grating",
}


def number(text: Column) -> Column:
    """The text as a number; null if it is none (keep the text beside it)."""
    t = F.trim(text)
    return F.coalesce(t.try_cast("bigint").cast("double"), t.try_cast("double"))


def whole_number(text: Column) -> Column:
    return F.trim(text).try_cast("bigint")


def items(text: Column, delimiter: str = ";") -> Column:
    """Trimmed items of a list field; null or blank gives an empty list."""
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(text, f"\\Q{delimiter}\\E"), lambda x: F.trim(x)))


def lookup(code: Column, names: dict) -> Column:
    """The name of a code, null if it has none."""
    pairs = [F.lit(v) for pair in names.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), code)


def tagged_times(text: Column) -> Column:
    """A field of comma-separated times, 'UT h:m', 'ST h:m' or plain, as a struct (civil, ut, st); of several of a kind the last counts."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    tail = lambda tag: F.trim(F.substring(F.try_element_at(F.filter(parts, lambda x: F.upper(F.substring(x, 1, 2)) == tag), F.lit(-1)), 3, 1_000_000))
    plain = F.try_element_at(F.filter(parts, lambda x: (x != "") & ~F.upper(F.substring(x, 1, 2)).isin("UT", "ST")), F.lit(-1))
    return F.struct(plain.alias("civil"), tail("UT").alias("ut"), tail("ST").alias("st"))


def combined_times(civil: Column, ut: Column, st: Column) -> Column:
    """Lists of civil, universal and sidereal times as one list of tagged texts; the shorter lists lack the last items.

    A first item that is tagged already is replaced by the one of its kind.
    """
    empty = F.array().cast("array<string>")
    zipped = F.arrays_zip(F.coalesce(civil, empty).alias("c"), F.coalesce(ut, empty).alias("u"), F.coalesce(st, empty).alias("s"))

    def one(x: Column) -> Column:
        tagged = lambda tag, v: F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{tag} "), v))
        u, s = tagged("UT", x["u"]), tagged("ST", x["s"])
        kind = F.substring(x["c"], 1, 2)
        keep = F.when((x["c"] != "") & ~((kind == "UT") & u.isNotNull()) & ~((kind == "ST") & s.isNotNull()), x["c"])
        return F.concat_ws(", ", keep, u, s)

    return F.transform(zipped, one)


# Letters that have no decomposition.
LIGATURES = (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("þ", "th"), ("Þ", "Th"))
STROKED = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ı": "i"}


def _letters() -> tuple[str, str]:
    """Letters of the Latin blocks and the ASCII letters that their canonical decompositions begin with."""
    plain = dict(STROKED)
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        first = unicodedata.normalize("NFD", chr(point))[0]
        if first != chr(point) and first.isascii() and first.isalpha():
            plain[chr(point)] = first
    return "".join(plain), "".join(plain.values())


_LETTERS = _letters()


def ascii_folded(text: Column, german: bool = False) -> Column:
    """Letters without diacritics; with `german`, umlauts become two letters first; other characters beyond ASCII become '?'."""
    out = text
    if german:
        for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
            out = F.replace(out, F.lit(a), F.lit(b))
    for a, b in LIGATURES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(F.translate(out, *_LETTERS), r"[^\x00-\x7F]", "?")


def file_format(name: Column) -> Column:
    ending = F.upper(F.substring_index(name, ".", -1))
    return F.when(ending.isin("JPG", "JPEG"), "JPEG").when(ending.isin("TIF", "TIFF"), "TIFF")


def key_values(text: Column, default: str = "notes") -> Column:
    """'key: value; key: value' as an array of (key in lower case, value) in order; a part without a colon has the default key."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    colon = lambda x: F.locate(":", x)
    return F.transform(
        parts,
        lambda x: F.struct(
            F.when(colon(x) > 0, F.lower(F.trim(F.substring_index(x, ":", 1)))).otherwise(default).alias("key"),
            F.when(colon(x) > 0, F.trim(F.substr(x, colon(x) + 1))).otherwise(x).alias("value"),
        ),
    )


def value_of(pairs: Column, key: str) -> Column:
    """The last value of a key, null if there is none."""
    return F.try_element_at(F.filter(pairs, lambda x: x["key"] == key), F.lit(-1))["value"]


def joined_values(pairs: Column, key: str, known: tuple[str, ...] = ()) -> Column:
    """All values of a key, and unknown 'key: value' parts, joined by '; '; null if there are none."""
    chosen = F.filter(pairs, lambda x: (x["key"] == key) | ~x["key"].isin(key, *known)) if known else F.filter(pairs, lambda x: x["key"] == key)
    shown = F.transform(chosen, lambda x: F.when(x["key"] == key, x["value"]).otherwise(F.concat_ws(": ", x["key"], x["value"])))
    return F.when(F.size(shown) > 0, F.array_join(shown, "; "))


def padded_id(*parts: tuple[Column, int]) -> Column:
    """Numbers joined by '-', each with leading zeros to its width."""
    return F.concat_ws("-", *(F.lpad(c.cast("string"), w, "0") for c, w in parts))


def box_region(ra: Column, dec: Column, width: Column, height: Column) -> Column:
    return F.format_string("Box ICRS %.5f %.5f %.5f %.5f", ra, dec, width, height)


def polygon_region(corners: Column) -> Column:
    """Corners: array of structs (ra, dec)."""
    return F.concat(F.lit("Polygon ICRS "), F.array_join(F.transform(corners, lambda c: F.format_string("%.5f %.5f", c["ra"], c["dec"])), " "))


def log_line(ts: Column, solution: Column, message: Column) -> Column:
    return F.concat(F.lit("["), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("] "), F.when(solution.isNotNull(), F.concat(F.lit("{Solution "), solution.cast("string"), F.lit("} "))).otherwise(""), message)
