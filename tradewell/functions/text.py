"""Number formats, name cleaning and sentence templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_names(names: list[str]) -> list[str]:
    """Letters, digits and single underscores only; collisions get a running suffix."""
    taken: set[str] = set()
    result = []
    for raw in names:
        base = "_".join(re.findall(r"[0-9A-Za-z]+", str(raw))) or "unnamed_column"
        name, n = base, 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        result.append(name)
    return result


def whole(x: Column) -> Column:
    """X05 ``#,##0``: thousands separated, half away from zero."""
    return F.format_number(F.round(x.cast("double"), 0), 0)


def dollars(x: Column) -> Column:
    """X05 ``$#,##0``."""
    return F.concat(F.lit("$"), whole(x))


def fixed(x: Column, digits: int) -> Column:
    """X05 ``0.0``: fixed digits, no thousands separator."""
    return F.format_string(f"%.{digits}f", F.round(x.cast("double"), digits))


def percent(x: Column, digits: int = 0) -> Column:
    """X05 ``0%`` and ``0.0%``; null stays null."""
    return F.when(x.isNotNull(), F.concat(fixed(x.cast("double") * 100, digits), F.lit("%")))


def fill(template: str, **parts: Column) -> Column:
    """Put columns into ``{name}`` places of a sentence; a null part reads as no text."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(F.coalesce(parts[piece].cast("string"), F.lit("")))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)
