"""Character classes of the tokenizers' split patterns, as bodies of bracket expressions for ``re``.

Built from the Unicode categories, as ``re`` has no ``\\p{..}``.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

#: Unicode White_Space, which the patterns' \\s means (fixed values).
SPACE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def points(category: str) -> list[int]:
    """Code points whose category begins with ``category``."""
    return [p for p in range(0x110000) if unicodedata.category(chr(p))[0] == category]


def ranges(of: list[int]) -> str:
    found: list[list[int]] = []
    for p in of:
        if found and found[-1][1] == p - 1:
            found[-1][1] = p
        else:
            found.append([p, p])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in found)


LETTERS, NUMBERS, SPACES = ranges(points("L")), ranges(points("N")), ranges(SPACE_POINTS)
