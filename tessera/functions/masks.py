"""Run-length masks as column expressions: COCO's counts, plain or packed as text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One mask: counts of zeros and ones in turn, down the columns, zeros first; either plain or packed as text.
RLE = "struct<height:int,width:int,counts:array<bigint>,packed:string>"

# Fixed values of the packed form: five bits a character, a continuation bit, printable from "0" on.
_BITS, _MORE, _SIGN, _FIRST = 5, 32, 16, 48
_GROUPS = 13  # characters that a 64-bit number can take

_LOT = 1 << 18  # values of lists worked on at once, or those of one list


def polygons_of(text: Column) -> Column:
    """Flat polygons of a segmentation given as JSON text; NULL for another form."""
    return F.when(text.startswith("["), F.from_json(text, "array<array<double>>"))


def rle_of(text: Column) -> Column:
    """The run-length mask of a segmentation given as JSON text; NULL for another form.

    Packed counts may begin with a bracket but never end with one, as that is a character
    with the continuation bit.
    """
    raw = F.from_json(text, "struct<size:array<int>,counts:string>")
    plain = raw["counts"].startswith("[") & raw["counts"].endswith("]")
    return F.when(
        text.startswith("{") & raw["counts"].isNotNull(),
        F.struct(
            F.get(raw["size"], 0).alias("height"),
            F.get(raw["size"], 1).alias("width"),
            F.when(plain, F.from_json(raw["counts"], "array<bigint>")).alias("counts"),
            F.when(~plain, raw["counts"]).alias("packed"),
        ),
    )


def rle_json(rle: Column) -> Column:
    """A mask as COCO's JSON object; NULL for a NULL mask."""
    size = F.array(rle["height"], rle["width"])
    plain = F.to_json(F.struct(size.alias("size"), rle["counts"].alias("counts")))
    packed = F.to_json(F.struct(size.alias("size"), rle["packed"].alias("counts")))
    return F.when(rle.isNotNull(), F.when(rle["packed"].isNotNull(), packed).otherwise(plain))


def lots(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """From and to of consecutive lists that hold about ``_LOT`` values together."""
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // _LOT)) + 1).tolist(), len(sizes)]
    return zip(edges, edges[1:])


def lengths(lists: pa.Array) -> np.ndarray:
    """Values of each list; a NULL list has none."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def longs(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def as_lists(values: list[np.ndarray], sizes: np.ndarray, missing: pa.Array) -> pa.Array:
    """Lists of ``sizes`` values each, NULL where ``missing`` is true."""
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *values])), mask=missing)


def _packed(counts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the texts of all lists, one after the other, and how many each has."""
    pos = np.arange(len(counts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    number = counts.copy()
    far = np.flatnonzero(pos > 2)
    number[far] -= counts[far - 2]
    size = np.where(number < 0, ~number, number)
    groups = np.ones(len(counts), np.int64)
    for g in range(1, _GROUPS):
        larger = size >> (_BITS * g - 1) > 0
        if not larger.any():
            break
        groups += larger
    at = np.append(0, np.cumsum(groups))
    k = np.arange(at[-1]) - np.repeat(at[:-1], groups)
    more = np.where(k < np.repeat(groups, groups) - 1, _MORE, 0)
    text = (((np.repeat(number, groups) >> (_BITS * k)) & 31) + more + _FIRST).astype(np.uint8)
    return text, np.diff(at[np.append(0, np.cumsum(sizes))])


@F.arrow_udf(T.StringType())
def pack_counts(counts: pa.Array) -> pa.Array:
    """Counts as text: each from the fourth on is written as its difference from the last but one before it."""
    sizes = lengths(counts)
    made = [_packed(longs(counts[a:b].flatten()), sizes[a:b]) for a, b in lots(sizes)]
    ends = np.append(0, np.cumsum(np.concatenate([n for _, n in made])))
    buffers = [pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.concatenate([t for t, _ in made]))]
    texts = pa.Array.from_buffers(pa.string(), len(counts), [None, *buffers])
    return pc.if_else(counts.is_valid(), texts, None) if counts.null_count else texts


def unpacked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts of texts, one after the other, and how many each text has; NULL has none."""
    texts = pc.fill_null(texts, "").cast(pa.binary())
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    if (raw > 127).any():
        raise ValueError("packed counts are ASCII text")
    codes, at = raw.view(np.int8) - np.int8(_FIRST), at - at[0]
    last = np.flatnonzero((codes & _MORE) == 0)
    owner = np.searchsorted(at, last, "right") - 1
    first = np.maximum(np.append(0, last[:-1] + 1), at[owner]) if len(last) else last  # what a text leaves open at its end is no number
    size = last - first + 1
    number = np.zeros(len(last), np.int64)
    place = np.arange(len(last))
    k = 0
    while len(place):  # the k-th character of the numbers that have one
        number[place] += (codes[first[place] + k] & 31).astype(np.int64) << (_BITS * k)
        k += 1
        place = place[size[place] > k]
    below = ((codes[last] & _SIGN) != 0) & (size < _GROUPS)  # a number of all groups carries its sign
    number[below] -= np.int64(1) << (_BITS * size[below])
    sizes = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(sizes) - sizes
    pos = np.arange(len(number)) - np.repeat(begin, sizes)
    for part in (pos % 2 == 1, (pos % 2 == 0) & (pos > 0)):
        total = np.append(0, np.cumsum(np.where(part, number, 0)))
        number = np.where(part, total[1:] - np.repeat(total[begin], sizes), number)
    return number, sizes


@F.arrow_udf(T.ArrayType(T.LongType()))
def unpack_counts(packed: pa.Array) -> pa.Array:
    """Counts written as text."""
    made = [unpacked(packed[a:b]) for a, b in lots(text_lengths(packed))]
    return as_lists([v for v, _ in made], np.concatenate([n for _, n in made]), packed.is_null())


@F.arrow_udf(T.ArrayType(T.LongType()))
def either_counts(plain: pa.Array, packed: pa.Array) -> pa.Array:
    """Plain counts, or where they are NULL those written as text."""
    if packed.null_count == len(packed):
        return plain
    made = [unpacked(packed[a:b]) for a, b in lots(text_lengths(packed))]
    read = as_lists([v for v, _ in made], np.concatenate([n for _, n in made]), packed.is_null())
    return read if plain.null_count == len(plain) else pc.if_else(plain.is_valid(), plain, read)


@F.arrow_udf(T.IntegerType())
def list_size(counts: pa.Array) -> pa.Array:
    return pc.list_value_length(counts)


def text_lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


@F.arrow_udf(T.StringType())
def joined_text(counts: pa.Array) -> pa.Array:
    """Counts with commas between them."""
    texts = pa.ListArray.from_arrays(counts.offsets, counts.values.cast(pa.string()), mask=counts.is_null())
    return pc.binary_join(texts, ",")
