"""Scalar functions on columns; all built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LETTERS, _HEX = "abcdefghijklmnop", "0123456789abcdef"


def cell_number(cell_id: Column) -> Column:
    """Cell id such as 'aaaachba-1' to bigint, counted from 1 so that 0 is background."""
    return F.conv(F.translate(F.substring_index(cell_id, "-", 1), _LETTERS, _HEX), 16, 10).cast("bigint") + 1


def cell_name(number: Column) -> Column:
    """Inverse of ``cell_number``."""
    return F.concat(F.translate(F.lpad(F.lower(F.hex(number - 1)), 8, "0"), _HEX, _LETTERS), F.lit("-1"))


def tissue_of(slide_id: Column) -> Column:
    """Slide id without its last '_' part."""
    return F.regexp_replace(slide_id, "_[^_]*$", "")


def part_from_right(text: Column, sep: str = "_") -> Column:
    return F.substring_index(text, sep, -1)


def without_suffix(text: Column, suffix: str) -> Column:
    return F.when(text.endswith(suffix), F.left(text, F.length(text) - len(suffix))).otherwise(text)


def without_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.right(text, F.length(text) - len(prefix))).otherwise(text)


def number_of_file(name: Column, suffix: str = ".png") -> Column:
    """'123.png' to 123; null where the rest is not a whole number."""
    return without_suffix(name, suffix).try_cast("bigint")


def joined(*columns: Column, sep: str = "_") -> Column:
    """Columns as strings with ``sep`` between; a null is written 'nan'."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("nan")) for c in columns])


def comma_list(items: Column) -> Column:
    return F.array_join(items.cast("array<string>"), ",")


def comma_parts(text: Column) -> Column:
    """Parts of a comma list, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def nan_to(text: Column, value: str = "Unknown") -> Column:
    """Null and the string 'nan' become ``value``."""
    return F.when(text.isNull() | (text == "nan"), F.lit(value)).otherwise(text)


def null_if_nan(x: Column) -> Column:
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def clip_low(x: Column, least: float = 0.0) -> Column:
    return F.greatest(x, F.lit(least))


def rgb_hex(red: Column, green: Column, blue: Column) -> Column:
    return F.lower(F.concat(F.lit("#"), *[F.lpad(F.hex(c.cast("bigint")), 2, "0") for c in (red, green, blue)]))


def with_alpha(rgb: Column, alpha: float) -> Column:
    """Channels scaled to 0..1 and alpha appended."""
    return F.concat(F.transform(rgb, lambda c: c / F.lit(255.0)), F.array(F.lit(float(alpha))))


def inverted(mapping: Column) -> Column:
    """Map with keys and values exchanged; of equal values the last key stays."""
    entries = F.map_entries(mapping)
    last = lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["value"] == e["value"])
    return F.map_from_entries(F.transform(F.filter(entries, last), lambda e: F.struct(e["value"], e["key"])))


def python_round(x: Column, digits: int = 2) -> Column:
    """Round half to even."""
    return F.bround(x, digits)


def training_prefix(training_id: Column) -> Column:
    return F.replace(training_id, F.lit("training_"), F.lit("t"))


def affine(x: Column, y: Column, matrix: tuple[float, float, float, float, float, float]) -> tuple[Column, Column]:
    """(a b c; d e f) applied to (x, y)."""
    a, b, c, d, e, f = map(F.lit, matrix)
    return a * x + b * y + c, d * x + e * y + f


def scaled(x: Column, factor: float) -> Column:
    return x if factor == 1 else x * F.lit(factor)


def first_max(values: Column) -> Column:
    """Index from 0 of the first greatest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def argmax_with_background(values: Column) -> Column:
    """Argmax after a zero background channel is put in front."""
    return first_max(F.concat(F.array(F.lit(0).cast("double")), values.cast("array<double>")))


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> list[Column]:
    """Bounds truncated toward zero."""
    return [c.cast("int").alias(n) for c, n in zip((xmin, ymin, xmax, ymax), ("xmin", "ymin", "xmax", "ymax"), strict=True)]


def is_40x(pixel_size: Column, expected: float = 0.2125) -> Column:
    return F.abs(pixel_size - F.lit(expected)) < 1e-9


def map_of(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def grouping(text: Column) -> Column:
    """JSON such as '{"new": ["a", "b"]}' as a map of lists."""
    return F.from_json(text, "map<string,array<string>>")


def named_components(vec: Column, prefix: str, n: int) -> list[Column]:
    """The first n components as columns prefix_1 .. prefix_n."""
    return [F.get(vec, F.lit(i)).alias(f"{prefix}_{i + 1}") for i in range(n)]
