"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the address clean-up removes. In the first pattern the dot
# stands for any character, so "no" goes together with whatever follows it, also
# inside a word. The second removes only a literal "no.".
ADDRESS_MARKS = "no.|#"
ADDRESS_MARKS_LITERAL = r"no\.|#"


def lowered(column: Column | str) -> Column:
    """Lower-cased text without surrounding blanks."""
    return F.lower(F.trim(column))


def without_dashes(column: Column | str) -> Column:
    """A phone number without ``-`` and surrounding blanks."""
    return F.replace(F.trim(column), F.lit("-"), F.lit(""))


def plain_address(column: Column | str, marks: str = ADDRESS_MARKS) -> Column:
    """A lower-cased address without house number marks."""
    return F.regexp_replace(lowered(column), marks, "")


def fixed_width(*parts: tuple[Column | str, int], gap: dict[int, str] | None = None) -> Column:
    """Left-justified fields of the given widths; ``gap`` adds text after field *i*."""
    gap = gap or {}
    pattern = "".join(f"%-{width}s{gap.get(i, '')}" for i, (_, width) in enumerate(parts))
    return F.format_string(pattern, *[column for column, _ in parts])
