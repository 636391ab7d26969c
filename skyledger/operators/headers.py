"""Image headers as ordered arrays of cards (pos, key, value, comment): keys may repeat and order counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def card(key: str | Column, value: Column, comment: str | Column | None = None) -> Column:
    name = F.lit(key) if isinstance(key, str) else key
    note = F.lit(comment) if isinstance(comment, str) or comment is None else comment
    return F.struct(F.lit(0).alias("pos"), name.alias("key"), value.cast("string").alias("value"), note.cast("string").alias("comment"))


def numbered(cards: Column) -> Column:
    """Positions anew from 0."""
    return F.transform(cards, lambda c, i: F.struct(i.alias("pos"), c["key"].alias("key"), c["value"].alias("value"), c["comment"].alias("comment")))


def value_of(cards: Column, key: str) -> Column:
    return F.try_element_at(F.filter(cards, lambda c: c["key"] == key), F.lit(1))["value"]


def values_of(cards: Column, stem: str) -> Column:
    """The value of a key, then those of its numbered forms (KEY1, KEY2 ...) by number."""
    found = F.filter(cards, lambda c: (c["key"] == stem) | c["key"].rlike(f"^{stem}[0-9]+$"))
    keyed = F.transform(found, lambda c: F.struct(F.coalesce(F.regexp_extract(c["key"], "([0-9]+)$", 1).try_cast("int"), F.lit(0)).alias("n"), c["value"].alias("v")))
    return F.transform(F.filter(F.array_sort(keyed), lambda x: x["v"].isNotNull()), lambda x: x["v"])


def updated(cards: Column, key: str, value: Column, comment: str | None = None) -> Column:
    """The key's card with a new value (its comment stays unless one is given), or a new last card; a null value changes nothing."""
    fresh = F.transform(cards, lambda c: F.when(c["key"] == key, F.struct(c["pos"].alias("pos"), c["key"].alias("key"), value.cast("string").alias("value"), F.coalesce(F.lit(comment).cast("string"), c["comment"]).alias("comment"))).otherwise(c))
    return F.when(value.isNull(), cards).when(F.exists(cards, lambda c: c["key"] == key), fresh).otherwise(numbered(F.concat(cards, F.array(card(key, value, comment)))))


def updated_list(cards: Column, stem: str, values: Column, comment: str | None = None) -> Column:
    """Cards of a list: KEY for one value, KEY1, KEY2 ... for several; earlier ones of the same stem go."""
    others = F.filter(cards, lambda c: ~((c["key"] == stem) | c["key"].rlike(f"^{stem}[0-9]+$")))
    note = (lambda i: F.lit(None).cast("string")) if comment is None else (lambda i: F.concat(F.lit(comment), F.lit(" "), (i + 1).cast("string")))
    fresh = F.transform(values, lambda v, i: F.struct(F.lit(0).alias("pos"), F.when(F.size(values) == 1, F.lit(stem)).otherwise(F.concat(F.lit(stem), (i + 1).cast("string"))).alias("key"), v.cast("string").alias("value"), note(i).alias("comment")))
    return numbered(F.concat(others, fresh))


def renamed(cards: Column, names: dict[str, str]) -> Column:
    table = F.create_map(*(F.lit(v) for pair in names.items() for v in pair))
    return F.transform(cards, lambda c: F.struct(c["pos"].alias("pos"), F.coalesce(F.try_element_at(table, c["key"]), c["key"]).alias("key"), c["value"].alias("value"), c["comment"].alias("comment")))


def assigned(cards: Column, constants: dict[str, str]) -> Column:
    for key, value in constants.items():
        cards = updated(cards, key, F.lit(value))
    return cards


def without_comments(cards: Column) -> Column:
    return F.filter(cards, lambda c: ~c["key"].isin("COMMENT", "HISTORY", ""))


def reordered(cards: Column, order: list[str]) -> Column:
    """Cards by the place of their key (numbered forms with their stem) in `order`, others after them as they stood."""
    places = F.lit(order)

    def rank(c: Column) -> Column:
        at = F.array_position(places, c["key"])
        stem = F.array_position(places, F.regexp_replace(c["key"], "[0-9]+$", ""))
        return F.when(at > 0, at).when(stem > 0, stem).otherwise(len(order) + 1)

    keyed = F.transform(cards, lambda c: F.struct(rank(c).alias("r"), c["pos"].alias("p"), c.alias("c")))
    return numbered(F.transform(F.array_sort(keyed), lambda x: x["c"]))


def merged(cards: Column, other: Column) -> Column:
    """`cards` with values of the other header where keys agree, its other keys after them; free-text cards are not merged."""
    new = without_comments(other)
    value = lambda c: F.try_element_at(F.filter(new, lambda o: o["key"] == c["key"]), F.lit(1))
    fresh = F.transform(cards, lambda c: F.coalesce(F.when(~c["key"].isin("COMMENT", "HISTORY", ""), value(c)), c))
    missing = F.filter(new, lambda o: ~F.exists(cards, lambda c: c["key"] == o["key"]))
    return numbered(F.concat(fresh, missing))


def with_wcs(cards: Column, wcs: Column, before: str = "HISTORY") -> Column:
    """A solution's cards put before the first card of a key, or at the end; earlier cards of the same keys go."""
    kept = F.filter(cards, lambda c: ~F.exists(wcs, lambda w: (w["key"] == c["key"]) & ~w["key"].isin("COMMENT", "HISTORY", "")))
    at = F.array_position(F.transform(kept, lambda c: c["key"]), before)
    cut = F.when(at > 0, at - 1).otherwise(F.size(kept)).cast("int")
    return numbered(F.concat(F.filter(kept, lambda c, i: i < cut), wcs, F.filter(kept, lambda c, i: i >= cut)))


def alternate(cards: Column, letter: str) -> Column:
    """A solution's cards under an alternate letter, for several solutions in one header."""
    return F.transform(cards, lambda c: F.struct(c["pos"].alias("pos"), F.concat(c["key"], F.lit(letter)).alias("key"), c["value"].alias("value"), c["comment"].alias("comment")))


# Edits of values


def plate_sizes(size: Column) -> tuple[Column, Column]:
    """Both numbers of 'AxB'; null where there are none."""
    parts = F.split(size, "x")
    return F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")


def seconds_of_minutes(minutes: Column, stated: Column | None = None) -> Column:
    """An exposure time of minutes in seconds; where it is missing the one stated elsewhere, also in minutes."""
    own = minutes.cast("string").try_cast("double")
    return (own if stated is None else F.coalesce(own, stated.cast("double"))) * F.lit(60.0)


def named_observer(name: Column) -> Column:
    """A space after each initial's point, and a capital after whatever isn't a letter: blanks, hyphens, apostrophes."""
    return F.array_join(F.transform(F.split(F.replace(name, F.lit("."), F.lit(". ")), r"(?<=\P{L})"), lambda part: F.initcap(part)), "")


def plain_filter(name: Column) -> Column:
    """'NONE' and 'NO' within a filter's name are 'none'."""
    return F.replace(F.replace(name, F.lit("NONE"), F.lit("none")), F.lit("NO"), F.lit("none"))


def plain_prism_angle(angle: Column) -> Column:
    return F.replace(angle, F.lit("NO"), F.lit(""))


def joined_date(date: Column, time: Column) -> Column:
    """Date and time in one text; the date alone without a time."""
    return F.when(time.isNotNull(), F.concat(date, F.lit("T"), time)).otherwise(date)


def evening_date(start: Column) -> Column:
    """The date of the evening that a night's observation belongs to: that of twelve hours before."""
    return F.date_format(F.try_to_timestamp(start) - F.expr("INTERVAL 12 HOURS"), "yyyy-MM-dd")
