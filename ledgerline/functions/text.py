"""Text expressions: masking, whitespace, lines, paths. All are built-in Spark columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every letter becomes X and every digit becomes 9. The dotless i and the long s are
# the two other characters whose upper case is a single letter A-Z.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzıſ"
DIGITS = "0123456789"
LETTER_MASK = "X"
DIGIT_MASK = "9"

# The default masked range (0-based, both ends included) and the default masked fields.
DEFAULT_RANGES = ((7, 16),)
DEFAULT_FIELDS = (5, 6, 7, 8)

# Any Unicode space, and the four separators U+001C to U+001F.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
# Line ends of a text file, and the further ones some readers also break at.
_LINE_END = r"\r\n|\n|\r"
_WIDE_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

_TO_END = 2147483647


def mask_text(text: Column) -> Column:
    """Every letter to X, every digit to 9, all else as it is."""
    return F.translate(
        text, LETTERS + DIGITS, LETTER_MASK * len(LETTERS) + DIGIT_MASK * len(DIGITS)
    )


def maskable_chars(text: Column) -> Column:
    """How many characters of ``text`` masking replaces."""
    kept = F.translate(text, LETTERS + DIGITS, "")
    return (F.length(text) - F.length(kept)).cast("long")


def merge_ranges(ranges: Iterable[Sequence[int]]) -> list[tuple[int, int]]:
    """Union of 0-based ranges with both ends included, in order and without overlap."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted((int(s), int(e)) for s, e in ranges):
        if start < 0 or end < start:
            raise ValueError(f"bad mask range: {start}..{end}")
        if merged and start <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    if not merged:
        raise ValueError("no mask range given")
    return merged


def _slice(text: Column, start: int, length: int = _TO_END) -> Column:
    return F.substring(text, start + 1, length)


def mask_ranges(line: Column, ranges: Iterable[Sequence[int]] = DEFAULT_RANGES) -> Column:
    """Mask the characters in the union of ``ranges`` (0-based, both ends included)."""
    pieces: list[Column] = []
    done = 0
    for start, end in merge_ranges(ranges):
        if start > done:
            pieces.append(_slice(line, done, start - done))
        pieces.append(mask_text(_slice(line, start, end - start + 1)))
        done = end + 1
    return F.concat(*pieces, _slice(line, done))


def ranges_chars(line: Column, ranges: Iterable[Sequence[int]] = DEFAULT_RANGES) -> Column:
    """How many characters ``mask_ranges`` replaces."""
    return maskable_chars(F.concat(*[_slice(line, s, e - s + 1) for s, e in merge_ranges(ranges)]))


def split_literal(text: Column, delimiter: str) -> Column:
    """Split at a literal delimiter, keeping empty fields."""
    if not delimiter:
        raise ValueError("the delimiter is empty")
    return F.split(text, re.escape(delimiter) if len(delimiter) == 1 else _quoted(delimiter), -1)


def _quoted(literal: str) -> str:
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _wanted(columns: Iterable[int]) -> list[int]:
    wanted = sorted({int(c) for c in columns})
    if not wanted or wanted[0] < 0:
        raise ValueError(f"bad field numbers: {wanted}")
    return wanted


def _runs(columns: Iterable[int]) -> list[tuple[int, int]]:
    """Field numbers as runs of neighbours, first and last included."""
    return merge_ranges((c, c) for c in _wanted(columns))


def _cuttable(delimiter: str) -> bool:
    """Whether fields can be cut out and masked with the delimiters between them in place."""
    return len(delimiter) == 1 and delimiter not in LETTERS + DIGITS


def _cut_fields(line: Column, delimiter: str, columns: Iterable[int]) -> list[tuple[bool, Column]]:
    """The line in pieces, each with whether it is a run of wanted fields and their delimiters."""
    pieces: list[tuple[bool, Column]] = []
    done = F.lit(0)
    for first, last in _runs(columns):
        before = F.length(F.substring_index(line, delimiter, first)) if first else F.lit(0)
        through = F.length(F.substring_index(line, delimiter, last + 1))
        if first:
            pieces.append((False, F.substring(line, done + 1, before - done)))
        pieces.append((True, F.substring(line, before + 1, through - before)))
        done = through
    pieces.append((False, F.substring(line, done + 1, F.lit(_TO_END))))
    return pieces


def mask_fields(line: Column, delimiter: str, columns: Iterable[int] = DEFAULT_FIELDS) -> Column:
    """Mask the 0-based ``columns`` of a literally delimited line; absent fields are ignored.

    With a usual delimiter only the runs of wanted fields are cut out; one that has letters or
    digits, or several characters, needs the line split into all its fields.
    """
    wanted = _wanted(columns)
    if delimiter and _cuttable(delimiter):
        pieces = _cut_fields(line, delimiter, wanted)
        return F.concat(*[mask_text(piece) if masked else piece for masked, piece in pieces])
    fields = F.transform(
        split_literal(line, delimiter),
        lambda value, i: F.when(i.isin(wanted), mask_text(value)).otherwise(value),
    )
    return F.array_join(fields, delimiter)


def fields_chars(line: Column, delimiter: str, columns: Iterable[int] = DEFAULT_FIELDS) -> Column:
    """How many characters ``mask_fields`` replaces."""
    wanted = _wanted(columns)
    if delimiter and _cuttable(delimiter):
        pieces = _cut_fields(line, delimiter, wanted)
        return maskable_chars(F.concat(*[piece for masked, piece in pieces if masked]))
    fields = F.filter(split_literal(line, delimiter), lambda _, i: i.isin(wanted))
    return maskable_chars(F.array_join(fields, ""))


def collapse_whitespace(text: Column) -> Column:
    """Each run of whitespace to one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, _SPACES, " "))


def text_lines(text: Column, unicode_breaks: bool = False) -> Column:
    """Array of the lines of a whole text; a final line end adds no empty line.

    A text without carriage returns, the common case, is split at line feeds without a pattern.
    """
    pattern = _WIDE_LINE_END if unicode_breaks else _LINE_END
    by_pattern = F.split(F.regexp_replace(text, rf"(?:{pattern})\z", ""), pattern, -1)
    lines = F.when(text == "", F.array().cast("array<string>"))
    if unicode_breaks:
        return lines.otherwise(by_pattern)
    body = F.when(text.endswith("\n"), F.substring(text, F.lit(1), F.length(text) - 1))
    by_feed = F.split(body.otherwise(text), "\n", -1)
    return lines.when(text.contains("\r"), by_pattern).otherwise(by_feed)


def contains_code(line: Column, kind: str, code: str, match: str) -> Column:
    """Whether ``line`` is a ``kind`` line (CH or CT) that holds the customer ``code``.

    ``regex``: the code is a pattern found anywhere after the tag; ``literal``: the code is plain
    text found anywhere after the tag.
    """
    if match == "regex":
        # (?d): a dot stops at a line feed only, as lines have no line feed it crosses everything.
        return line.rlike(f"(?d)^{kind}.*{code}")
    if match == "literal":
        return line.startswith(kind) & F.substring(line, len(kind) + 1, _TO_END).contains(code)
    raise ValueError(f"unknown match mode: {match}")


def first_match(line: Column, pattern: str, groups: int = 0) -> Column:
    """First match of a pattern, case ignored, as a one-element array of value, index and length.

    ``index`` (0-based) and ``length`` count UTF-16 units. With ``groups`` set, the texts of the
    first that many capture groups are added.
    """
    expression = F.lit(ignore_case(pattern))
    value = F.regexp_substr(line, expression)
    parts = [
        value.alias("value"),
        (F.regexp_instr(line, expression) - 1).cast("int").alias("index"),
        (F.octet_length(F.encode(value, "UTF-16BE")) / 2).cast("int").alias("length"),
    ]
    if groups:
        found = [F.regexp_extract(line, ignore_case(pattern), g) for g in range(1, groups + 1)]
        parts.append(F.array(*found).alias("groups"))
    return F.array(F.struct(*parts))


def ignore_case(pattern: str) -> str:
    """The pattern with case ignored."""
    return "(?iu)" + pattern


def native_path(entry: Column, separator: str = "\\") -> Column:
    """Archive entry name with the wanted path separator."""
    return F.replace(entry, F.lit("/"), F.lit(separator))


def containing_path(archive: Column, entry: Column, separator: str = "\\") -> Column:
    """Path of the archive joined with the folder of the entry; the archive alone at its root."""
    folder = F.regexp_extract(entry, r"(?s)^(.*)/[^/]*$", 1)
    inner = F.when(folder != "", native_path(folder, separator))
    return F.concat_ws(separator, archive, inner)
