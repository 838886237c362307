"""Text helpers: hashes, previews, size strings, blank lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Unit suffixes of a size string, 1024-based; no suffix means bytes.
SIZE_UNITS = {"KB": 1024, "MB": 1024 ** 2, "GB": 1024 ** 3}


def content_hash(content: Column) -> Column:
    """Hash that identifies a line. 256 bits, because a 32-bit hash would drop distinct lines."""
    return F.sha2(content, 256)


def string_hash32(content: Column) -> Column:
    """The 31-multiplier 32-bit string hash over UTF-16 units, for data that already carries it.

    A character beyond the basic plane is two units.
    """
    code = lambda ch: F.ascii(ch).cast("bigint")
    step = lambda acc, unit: F.pmod(acc * 31 + unit, F.lit(2 ** 32))
    wrapped = F.aggregate(
        F.split(content, ""),
        F.lit(0).cast("bigint"),
        lambda acc, ch: F.when(code(ch) < 0x10000, step(acc, code(ch))).otherwise(step(
            step(acc, F.lit(0xD7C0) + F.shiftright(code(ch), 10)), F.lit(0xDC00) + code(ch).bitwiseAND(F.lit(0x3FF)))),
    )
    return F.when(wrapped >= 2 ** 31, wrapped - 2 ** 32).otherwise(wrapped).cast("int")


def capture_groups(line: Column, pattern: str, count: int) -> Column:
    """All capture groups of a whole-line pattern as an array; see :func:`fits` for lines it does not match.

    One regex run per line instead of one per group: the match is rewritten to its
    groups joined by a control character and cut there. A line that itself holds the
    character takes the group-by-group way, so no line is read differently.
    """
    mark = "\x01"
    rewritten = F.regexp_replace(
        line, F.lit(pattern), F.lit(mark.join(f"${i + 1}" for i in range(count))))
    one_by_one = F.array(*[F.regexp_extract(line, pattern, i + 1) for i in range(count)])
    return F.when(
        F.contains(line, F.lit(mark)), F.when(line.rlike(pattern), one_by_one)
    ).otherwise(F.split(rewritten, mark))


def fits(groups: Column, count: int) -> Column:
    """Whether a line matched: otherwise its groups are null or the uncut line."""
    return F.coalesce(F.size(groups) == count, F.lit(False))


def preview(content: Column, length: int = 50) -> Column:
    return F.substring(content, 1, length)


def not_blank(line: Column) -> Column:
    """True for a line with a character above the space; nulls are blank."""
    return F.coalesce(F.regexp_like(line, F.lit(r"[^\x00-\x20]")), F.lit(False))


def size_in_bytes(text: Column) -> Column:
    """``100MB`` → 104857600; null for text that is no size."""
    number = F.regexp_extract(text, r"^(\d+)(KB|MB|GB)?$", 1)
    unit = F.regexp_extract(text, r"^(\d+)(KB|MB|GB)?$", 2)
    factor = F.lit(1)
    for name, value in SIZE_UNITS.items():
        factor = F.when(unit == name, F.lit(value)).otherwise(factor)
    return F.nullif(number, F.lit("")).try_cast("bigint") * factor


def parse_size(text: str | int) -> int:
    """The same rule for a setting given on the driver."""
    if isinstance(text, int):
        return text
    found = re.fullmatch(r"(\d+)(KB|MB|GB)?", text)
    if found is None:
        raise ValueError(f"not a size: {text!r}")
    return int(found[1]) * SIZE_UNITS.get(found[2], 1)


def contains_ignore_case(text: Column, keyword: str) -> Column:
    """Keyword search without case; ``%`` and ``_`` in the keyword stand for themselves."""
    return F.contains(F.upper(text), F.upper(F.lit(keyword)))


def like_keyword(text: Column, keyword: str) -> Column:
    """``LIKE %keyword%``: case counts, and ``%`` and ``_`` in the keyword stay wildcards."""
    return text.like(f"%{keyword}%")


def dash_to_null(text: Column) -> Column:
    """A lone ``-`` and the empty string both mean "missing" in access logs."""
    return F.nullif(F.nullif(text, F.lit("-")), F.lit(""))
