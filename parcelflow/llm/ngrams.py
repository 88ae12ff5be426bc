"""Character n-grams of whole texts as hashes, by numpy."""

from __future__ import annotations

import functools
import sys

import numpy as np

#: Odd 64-bit multipliers of the polynomial and the final mix.
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Code points whose n-grams are held at once.
AT_ONCE = 1_000_000
SPACE = 32


@functools.cache
def letters() -> np.ndarray:
    """Lower-case letter of each code point; everything that is no letter becomes a space."""
    table = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def plain(text: str) -> np.ndarray:
    """Code points of the letters, runs of anything else as one space, one space at both ends; empty without letters."""
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate(([SPACE], codes, [SPACE])).astype(np.uint64)
    gap = codes == SPACE
    kept = codes[~(gap & np.concatenate(([False], gap[:-1])))]
    return kept if len(kept) > 1 else kept[:0]


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash per n-gram, in order; a shorter text is one n-gram."""
    if not len(codes):
        return codes
    n = min(n, len(codes))
    size = len(codes) - n + 1
    rolled = codes[:size].copy()
    for i in range(1, n):
        rolled = rolled * BASE + codes[i : i + size]
    rolled ^= rolled >> np.uint64(31)
    rolled *= MIX
    return rolled ^ (rolled >> np.uint64(29))


def pieces(codes: np.ndarray, n: int):
    """The text in overlapping slices, so that every n-gram lies in exactly one."""
    for at in range(0, max(len(codes) - n + 1, 1), AT_ONCE):
        yield codes[at : at + AT_ONCE + n - 1]
