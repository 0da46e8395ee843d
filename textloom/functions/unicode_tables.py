"""Tables derived from the Unicode database when a plan is built."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from textloom.functions.patterns import EMOJI_RANGES

HANGUL = range(0xAC00, 0xD7A4)


@lru_cache(maxsize=None)
def accent_pairs() -> tuple[str, str]:
    """Precomposed characters of the basic plane and their bases, for ``translate``.

    An entry is a character whose canonical decomposition, without non-spacing marks, is one
    other character. Hangul syllables decompose into letters, not into a base and marks.
    """
    source, target = [], []
    for cp in range(0x80, 0x10000):
        if cp in HANGUL or 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        base = [c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0] != ch:
            source.append(ch)
            target.append(base[0])
    return "".join(source), "".join(target)


@lru_cache(maxsize=None)
def not_nfc_class(gap: int = 64) -> str:
    """A short character class that any text not in NFC must match.

    Marks and conjoining Hangul letters may combine or reorder; the rest are characters whose own
    NFC differs, close ones merged into one range. Texts without a match are already in NFC.
    """
    changed = [
        cp
        for cp in range(0x80, sys.maxunicode + 1)
        if not 0xD800 <= cp <= 0xDFFF
        and unicodedata.category(chr(cp))[0] != "M"
        and unicodedata.normalize("NFC", chr(cp)) != chr(cp)
    ]
    spans: list[list[int]] = []
    for cp in changed:
        if spans and cp - spans[-1][1] <= gap:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    body = "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in spans)
    return f"[\\p{{M}}\\x{{1160}}-\\x{{11FF}}{body}]"


@lru_cache(maxsize=None)
def emoji_names() -> dict[str, str]:
    """Emoji and its Unicode name in lower snake case."""
    names = {}
    for lo, hi in EMOJI_RANGES:
        for cp in range(lo, hi + 1):
            name = unicodedata.name(chr(cp), "")
            if name:
                names[chr(cp)] = name.lower().replace(" ", "_").replace("-", "_")
    return names
