"""Letters of texts as arrays of code points."""

from __future__ import annotations

from functools import cache

import numpy as np


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter (Unicode categories L*)."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of texts, each closed with a space; which of them
    are letters; and where each text begins (one more than texts)."""
    lowered = [t.lower() + " " for t in texts]
    data = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, _letters()[data], np.cumsum([0, *map(len, lowered)])
