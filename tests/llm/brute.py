"""Plain Python answers the operators are held against."""

from __future__ import annotations

import re
import zlib

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def asc_lower(text: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in text)


def simhash(text: str | None, shingle: int = 3) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", asc_lower((text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    digests = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def linked(prints: dict, radius: int) -> dict:
    """Smallest key reachable from each key over fingerprints within the radius."""
    least = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if least[b] < least[a] and (prints[a] ^ prints[b]).bit_count() <= radius:
                    least[a], changed = least[b], True
    return least


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", asc_lower((text or "").encode()))


def contaminated(text: str | None, items: list[tuple], window: int = 10) -> tuple[int, set[int], set]:
    """Number of words, places hit, and ids of the items found."""
    own, hit, ids = words(text), set(), set()
    for item, body in items:
        w = words(body)
        n = min(window, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in grams:
                hit.update(range(i, i + n))
                ids.add(item)
    return len(own), hit, ids


def fold(key: object) -> int:
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5
