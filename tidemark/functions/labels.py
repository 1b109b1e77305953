"""Text labels: numbers, names and states as readers see them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed

DASH = "—"


def _literal_map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def _signed(value: Column, digits: int) -> Column:
    """A plus sign for rises only: zero has no sign."""
    text = F.format_string(f"%.{digits}f", value)
    return F.when(value > 0, F.concat(F.lit("+"), text)).otherwise(text)


def _known(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def slope_label(slope: Column, digits: int = 3) -> Column:
    return F.when(_known(slope), _signed(slope, digits)).otherwise(DASH)


def p_label(p: Column) -> Column:
    return (
        F.when(~_known(p), DASH)
        .when(p < 0.001, "p < 0.001")
        .otherwise(F.concat(F.lit("p = "), F.format_string("%.3f", p)))
    )


def total_label(slope: Column, n: Column) -> Column:
    """Change over a record of ``n`` values at the given slope."""
    total = slope * (n - 1)
    return F.when(slope.isNotNull() & n.isNotNull(), _signed(total, 2)).otherwise(DASH)


def kebab_to_title(c: Column) -> Column:
    return F.initcap(F.translate(c, "-", " "))


def humanize(variable: Column) -> Column:
    """``soil_temp_c`` reads ``Soil temp``: unit suffixes go, the first word is capitalised."""
    units = [F.lit(u) for u in fixed.UNIT_SUFFIXES.split()]
    words = F.filter(F.split(variable, "_"), lambda w: ~F.array_contains(F.array(*units), w))
    text = F.array_join(words, " ")
    capitalised = F.concat(F.upper(F.substr(text, F.lit(1), F.lit(1))), F.substr(text, F.lit(2)))
    return F.when(F.size(words) == 0, variable).otherwise(capitalised)


def short_name(unit_name: Column) -> Column:
    return F.regexp_replace(unit_name, r" National Park( and Preserve)?$", "")


def state_codes(states: Column) -> Column:
    """``"CA,NV"`` or ``"CA/NV"`` as an array of trimmed, non-empty codes."""
    return F.filter(F.transform(F.split(states, "[,/]"), F.trim), lambda s: s != "")


def state_search_key(states: Column) -> Column:
    """Lower-case codes, each followed by the full name where it is known."""
    names = _literal_map(fixed.rows(fixed.STATE_NAMES))
    words = F.flatten(F.transform(state_codes(states), lambda s: F.array(s, F.try_element_at(names, s))))
    return F.lower(F.array_join(words, " "))


def region_of(states: Column) -> Column:
    """Region of the first state, ``Other`` where there is none."""
    pairs = [(code, region) for region, codes in fixed.rows(fixed.REGIONS) for code in codes.split()]
    first = F.trim(F.element_at(F.split(states, "[,/]"), 1))
    return F.coalesce(F.try_element_at(_literal_map(pairs), first), F.lit("Other"))


def file_key(stem: Column) -> Column:
    """``saguaro_part-1`` belongs to ``saguaro``."""
    return F.substring_index(stem, "_part-", 1)


def candidate_stems(key: Column, parts: Column | int) -> Column:
    """The names under which files of a key with so many parts may be found: whole, or by part."""
    count = F.lit(parts) if isinstance(parts, int) else parts
    numbered = F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count.cast("int") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(key, F.lit("_part-"), i.cast("string")),
    )
    return F.concat(F.array(key), numbered)


def part_label(multipart: Column, index: Column) -> Column:
    """``part-0`` and so on for keys with several parts, ``all`` for the rest."""
    return F.when(multipart, F.concat(F.lit("part-"), index.cast("string"))).otherwise("all")


def file_stem(key: Column, part: Column) -> Column:
    """The file name of a key, with its part where it has several."""
    return F.when(part == "all", key).otherwise(F.concat_ws("_", key, part))
