"""Packed identifiers, content identifiers and tonal patterns, as column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifiers are 5 bits of dynasty, 3 of kind, 23 of sequence; codes and namespaces are published.
KIND_SHIFT, DYNASTY_SHIFT = 23, 26
SEQUENCE_MOST, CUSTOM_FROM = (1 << 23) - 1, 8_000_000
DYNASTIES = {"unknown": 0, "preqin": 1, "han": 2, "wudai": 3, "tang": 4, "song": 5, "yuan": 6, "ming": 7, "qing": 8, "modern": 9, "weijin": 10, "nanbeichao": 11, "sui": 12, "jin": 13, "custom": 15, "sango": 16, "jinchao": 17}
KINDS = {"poem": 0, "ci": 1, "qu": 2, "prose": 3, "classic": 4, "fu": 5, "article": 6}
GENRES = {"shi": 1, "ci": 2, "qu": 3, "fu": 4, "sao": 5, "wen": 6, "xinshi": 7, "lian": 8}
KIND_GENRE = {"poem": 1, "ci": 2, "qu": 3, "prose": 6, "classic": 6, "fu": 4, "article": 6}
POEM_SPACE = "6f5b1c0e9a3d4f868c217d4e2a9b1f30"
AUTHOR_SPACE = "b41d7c620e584a939d172f6b8a5c0e31"
TONES = "仄平，。○？通"


def code(name: Column, codes: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])[name]


def name_of(value: Column, codes: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for k, v in codes.items() for x in (v, k)])[value.cast("int")]


def joined_bits(dynasty: Column, kind: Column, sequence: Column) -> Column:
    """The packed id, unchecked: a sequence beyond its bits runs into those of kind and dynasty."""
    return F.shiftleft(dynasty.cast("long"), DYNASTY_SHIFT).bitwiseOR(F.shiftleft(kind.cast("long"), KIND_SHIFT)).bitwiseOR(sequence.cast("long"))


def make_id(dynasty: Column, kind: Column, sequence: Column) -> Column:
    """The packed id of codes and a sequence number; an overflow raises instead of wrapping."""
    return F.when((sequence < 0) | (sequence > SEQUENCE_MOST), F.raise_error(F.concat(F.lit("sequence out of range: "), sequence.cast("string"))).cast("long")).otherwise(joined_bits(dynasty, kind, sequence))


def dynasty_of(packed: Column) -> Column:
    return F.shiftright(packed.cast("long"), DYNASTY_SHIFT).bitwiseAND(31)


def kind_of(packed: Column) -> Column:
    return F.shiftright(packed.cast("long"), KIND_SHIFT).bitwiseAND(7)


def sequence_of(packed: Column) -> Column:
    return packed.cast("long").bitwiseAND(SEQUENCE_MOST)


def within_dynasty(packed: Column, dynasty: int) -> Column:
    """A range instead of bits: scans can skip row groups by it."""
    return packed.between(dynasty << DYNASTY_SHIFT, ((dynasty + 1) << DYNASTY_SHIFT) - 1)


def uuid5(space: str, value: Column) -> Column:
    h = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(value, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("long").bitwiseAND(63).bitwiseOR(128)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 19, 2), F.lit("-"), F.substring(h, 21, 12))


def content_uid(*parts: Column) -> Column:
    return uuid5(POEM_SPACE, F.concat_ws("\x01", *[F.coalesce(p, F.lit("")) for p in parts]))


def author_uid(name: Column, dynasty: Column) -> Column:
    return uuid5(AUTHOR_SPACE, F.concat_ws("\x01", F.coalesce(name, F.lit("")), F.coalesce(dynasty, F.lit(""))))


def pack_tones(pattern: Column) -> Column:
    """Four bits a symbol, 7 for unknown ones, padded to whole bytes with 0."""
    digits = F.regexp_replace(F.translate(F.regexp_replace(pattern, "[0-9]", "x"), TONES, "0123456"), "[^0-6]", "7")
    return F.unhex(F.rpad(digits, (F.ceil(F.char_length(digits) / 2) * 2).cast("int"), F.lit("0")))


def unpack_tones(packed: Column, length: Column) -> Column:
    return F.left(F.translate(F.hex(packed), "01234567", TONES + "?"), length)
