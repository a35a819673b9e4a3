"""Instruction templates and names (survey rows X1-X24)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def placeholders(template: Column) -> Column:
    """The names in braces, in order."""
    return F.regexp_extract_all(template, F.lit(r"\{([^}]+)\}"), 1)


def is_arm(name: Column) -> Column:
    return name.rlike("^[a-z]$")


def template_fits(template: Column, params: Column) -> Column:
    """The placeholders are the parameters; or arms exist, none is used, and all the others are."""
    found, names = F.array_distinct(placeholders(template)), F.array_distinct(params)
    arms = F.filter(names, is_arm)
    same = lambda a, b: (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    return same(found, names) | ((F.size(arms) > 0) & same(F.array_union(found, arms), names) & ~F.arrays_overlap(found, arms))


def substitute(template: Column, values: Column) -> Column:
    """Every {name} of the map `values` by its text."""
    return F.aggregate(F.map_entries(values), template, lambda t, e: F.replace(t, F.concat(F.lit("{"), e.key, F.lit("}")), e.value))


def capitalize_sentence(c: Column) -> Column:
    """First letter upper, a period at the end; empty stays empty."""
    up = F.concat(F.upper(F.substring(c, 1, 1)), c.substr(F.lit(2), F.length(c)))
    return F.when(F.length(c) == 0, c).otherwise(F.when(up.endswith("."), up).otherwise(F.concat(up, F.lit("."))))


def safe_name(c: Column) -> Column:
    """Anything but letters, digits, dot and dash becomes _; outer _ go; nothing left is `unnamed`."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9.-]+", "_"), r"^_+|_+$", ""), F.lit("")), F.lit("unnamed"))


def episode_number(stem: Column) -> Column:
    """X11: the digits of a stem as a number; 10^12 without any."""
    return F.coalesce(F.nullif(F.regexp_extract(stem, r"([0-9]+)$", 1), F.lit("")).try_cast("bigint"), F.lit(10**12))


def camera_key(c: Column) -> Column:
    """X10."""
    return F.concat(F.lit("camera_"), F.regexp_replace(c, "_camera$", ""))


def has_prefix(c: Column, *prefixes: str) -> Column:
    """Whether c begins with one of the prefixes."""
    return F.exists(F.array(*map(F.lit, prefixes)), lambda p: c.startswith(p))


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.regexp_extract(path, "([^/]*)$", 1)


def parent_name(path: Column) -> Column:
    """The part before the last slash and after the one before; empty without two slashes."""
    return F.regexp_extract(path, "/([^/]*)/[^/]*$", 1)


def clean_instruction(c: Column, replacements: dict[str, str]) -> Column:
    """The regular expressions replaced in turn, blanks at the ends removed."""
    for pattern, new in replacements.items():
        c = F.regexp_replace(c, pattern, new)
    return F.trim(c)


def clip_key(episode: Column, clip: Column) -> Column:
    """Episode:clip000007."""
    return F.concat(episode, F.format_string(":clip%06d", clip))


def padding_of(kind: str) -> Column:
    """The padding of a column of that type: an empty text, or 0."""
    return F.lit("") if kind == "string" else F.lit(0).cast(kind)


def question(instruction: Column) -> Column:
    """The prompt around an instruction in lower case."""
    return F.concat(F.lit("What action should the robot take to "), F.lower(instruction), F.lit("?"))


def fill_cyclic(texts: Column, size: int) -> Column:
    """`size` texts, the given ones over and over; none from none."""
    n = F.size(texts)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.get(texts, k % n))).otherwise(F.array().cast("array<string>"))


def same_names(a: Column, b: Column) -> Column:
    """Both hold the same different names."""
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def disjoint(a: Column, b: Column) -> Column:
    """U3."""
    return ~F.arrays_overlap(a, b)


def default_text(c: Column, default: str) -> Column:
    """The default where the text is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def padding_mask(c: Column) -> Column:
    """Whether there is a text."""
    return F.coalesce(F.length(c) != 0, F.lit(False))


def json_fields(c: Column, schema: str) -> Column:
    """A struct of the fields of a JSON text; what is missing or of another type is null."""
    return F.from_json(c, schema)
