"""Text, JSON and property-list functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CUSTOM_FIELDS = "CountryOfManufacture string, Tags array<string>"


def between_parentheses(col: Column | str) -> Column:
    """Text inside the first pair of parentheses, '' when there is none."""
    return F.regexp_extract(col, r"\(([^)]*)\)", 1)


def first_letter(col: Column | str) -> Column:
    return F.left(F.col(col) if isinstance(col, str) else col, F.lit(1))


def trimmed(col: Column | str) -> Column:
    return F.trim(col)


def concat_text(*cols: Column) -> Column:
    """Concatenation of mixed types that reads NULL as ''."""
    return F.concat_ws("", *[c.cast("string") for c in cols])


def quoted_name(name: str) -> str:
    """A column name quoted for use in an expression."""
    return "`" + name.replace("`", "``") + "`"


def properties(col: Column | str) -> Column:
    """'a=1;b=2' to a map; of a repeated name the last value counts, a name without '=' has none."""
    pairs = F.transform(F.split(col, ";"), lambda part: F.split(part, "=", 2))
    names = F.transform(pairs, lambda p: F.element_at(p, 1))
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), F.element_at(p, 1)))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(F.element_at(p, 1), F.get(p, F.lit(1)))))


def json_fields(col: Column | str) -> list[Column]:
    """Country and first tag of a custom-fields JSON text; NULL where absent or malformed."""
    parsed = F.from_json(col, CUSTOM_FIELDS)
    return [
        parsed["CountryOfManufacture"].alias("country"),
        F.get(parsed["Tags"], F.lit(0)).alias("first_tag"),
    ]


def json_tags(col: Column | str) -> Column:
    """The Tags array of a custom-fields JSON text."""
    return F.from_json(col, CUSTOM_FIELDS)["Tags"]


def has_tag(col: Column | str, tag: str) -> Column:
    """True where one element of the row's own Tags equals ``tag``."""
    return F.coalesce(F.array_contains(json_tags(col), tag), F.lit(False))


def all_tags(col: Column | str, separator: str = ", ") -> Column:
    """All tags of a row in one text; the row stays, with NULL, even without tags."""
    tags = json_tags(col)
    return F.when(F.size(tags) > 0, F.array_join(tags, separator))
