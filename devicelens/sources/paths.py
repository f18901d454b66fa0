"""Folder selection by number range, for folders named by epoch ms."""

from __future__ import annotations


def prefix_cover(lo: int, hi: int, width: int) -> list[str]:
    """Glob patterns (a decimal prefix, then one ``?`` per free digit) whose
    ``width``-digit matches are exactly ``[lo, hi]``; at most ~18 per digit
    position.  ``?`` rather than ``*`` keeps a pattern from matching names
    of another width."""
    out = []
    while lo <= hi:
        k = 0
        while k < width and lo % 10 ** (k + 1) == 0 and lo + 10 ** (k + 1) - 1 <= hi:
            k += 1
        digits = str(lo).zfill(width)
        out.append(digits[: width - k] + "?" * k)
        lo += 10**k
    return out


def range_alternatives(lo: int, hi: int) -> list[str]:
    """Glob alternatives matching exactly the unpadded decimal names of the
    non-negative integers in ``[lo, hi]``, whatever the range's length."""
    lo = max(int(lo), 0)
    out = []
    for width in range(1, 20):
        a, b = max(lo, 10 ** (width - 1) if width > 1 else 0), min(int(hi), 10**width - 1)
        if a <= b:
            out += prefix_cover(a, b, width)
    return out


def range_glob(lo: int, hi: int) -> str | None:
    """``{alt1,alt2,...}`` for :func:`range_alternatives`, or None if empty."""
    alts = range_alternatives(lo, hi)
    return "{" + ",".join(alts) + "}" if alts else None
