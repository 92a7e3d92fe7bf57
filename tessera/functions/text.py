"""File names, log lines and name similarity as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------- file names


def stem(name: Column, rule: str = "last_dot") -> Column:
    """Name without extension: cut at the ``last_dot``, the ``first_dot``, or the last four characters."""
    if rule == "last_dot":
        return F.regexp_replace(name, r"\.[^.]*$", "")
    if rule == "first_dot":
        return F.substring_index(name, ".", 1)
    if rule == "last_four":
        return F.left(name, F.greatest(F.length(name) - 4, F.lit(0)))
    raise ValueError(f"unknown stem rule {rule!r}")


def extension(name: Column) -> Column:
    """Text after the last dot, without the dot."""
    return F.substring_index(name, ".", -1)


def tile_name(name: Column, tile_x: Column, tile_y: Column) -> Column:
    return F.concat(
        stem(name), F.lit("_tile_"), tile_x.cast("string"), F.lit("_"), tile_y.cast("string"), F.lit("."), extension(name)
    )


def tile_origin(name: Column) -> tuple[Column, Column]:
    """x and y back from a tile's file name; NULL when the name is not a tile name."""
    pattern = r"_tile_(\d+)_(\d+)\.[^.]*$"
    return tuple(F.regexp_extract(name, pattern, g).try_cast("long") for g in (1, 2))


def crop_name(data: Column, label: Column, x: Column, y: Column, w: Column, h: Column, name: Column) -> Column:
    box = [v.cast("int").cast("string") for v in (x, y, w, h)]
    return F.concat(F.concat_ws("_", data.cast("string"), label, *box), F.lit("."), extension(name))


def copy_name(name: Column, copy_no: Column, style: str = "suffix") -> Column:
    """Name of an augmented copy: ``<stem>_<i>.<ext>`` or ``augmented-<i>-<name>``."""
    if style == "suffix":
        return F.concat(stem(name), F.lit("_"), copy_no.cast("string"), F.lit("."), extension(name))
    if style == "prefix":
        return F.concat(F.lit("augmented-"), copy_no.cast("string"), F.lit("-"), name)
    raise ValueError(f"unknown copy name style {style!r}")


# ---------------------------------------------------------------- log lines


def metric_pairs(line: Column, tag: str = "INFO:") -> Column:
    """Array of (key, value text) from ``... tag key: value, key: value``."""
    body = F.trim(F.element_at(F.split(line, tag), -1))
    pieces = F.filter(F.split(body, ","), lambda p: p.contains(":"))
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.trim(F.substring_index(p, ":", 1)).alias("key"),
            F.trim(F.substring(p, F.locate(":", p) + 1, F.length(p))).alias("text"),
        ),
    )


def metric_number(key: Column, text: Column) -> Column:
    """Numeric reading of a metric: epoch from ``[3/100]``, otherwise a plain number, NULL for text."""
    epoch = F.split(F.regexp_replace(text, r"\[", ""), "/")[0].try_cast("int").cast("double")
    return F.when(key == "epoch", epoch).otherwise(text.try_cast("double"))


def metric_kind(key: Column, text: Column) -> Column:
    """``int``, ``float`` or ``string``, by the rule that a dot makes a float."""
    number = metric_number(key, text)
    return (
        F.when(number.isNull(), "string")
        .when(key == "epoch", "int")
        .when(text.contains("."), "float")
        .when(text.try_cast("long").isNotNull(), "int")
        .otherwise("string")
    )


def metric_phase(name: Column) -> Column:
    return F.when(name.startswith("val") | name.startswith("metrics"), "val").otherwise("train")


# ---------------------------------------------------------------- similarity


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two short texts.

    One table row per character of ``a``; the running maximum of a row is taken
    over its prefixes, so texts should be names, not documents.
    """
    chars_b = F.split(b, "")
    start = F.transform(chars_b, lambda _: F.lit(0))

    def step(row: Column, ch: Column) -> Column:
        candidate = F.transform(
            chars_b,
            lambda cb, j: F.greatest(
                row[j],
                F.when(j > 0, F.get(row, j - 1)).otherwise(F.lit(0)) + F.when(cb == ch, 1).otherwise(0),
            ),
        )
        return F.transform(candidate, lambda _, j: F.array_max(F.slice(candidate, 1, j + 1)))

    table = F.aggregate(F.split(a, ""), start, step)
    empty = (F.length(a) == 0) | (F.length(b) == 0)
    return F.when(empty, F.lit(0)).otherwise(F.element_at(table, -1))


def name_ratio(a: Column, b: Column) -> Column:
    """Similarity of two names in whole percent: twice the common subsequence over the total length."""
    total = F.length(a) + F.length(b)
    share = F.lit(200.0) * common_subsequence(a, b) / F.greatest(total, F.lit(1))
    return F.when(total == 0, F.lit(0)).otherwise(F.rint(share).cast("int"))
