"""Plain readings of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text: str | None) -> list[str]:
    return BLANK.findall(text or "")


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and luhn % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, in order."""
    return sorted(
        (m.start(), k, m.end())
        for k, (kind, pattern) in enumerate(PII.items())
        for m in re.finditer(pattern, text or "")
        if _holds(kind, m.group())
    )


def written(spans) -> str:
    names = list(PII)
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    found = words(text)
    lines = [line for line in (text or "").split("\n") if BLANK.search(line)]
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    hit = {i + k for i in range(len(found) - 2) for k in range(3) if windows[tuple(found[i : i + 3])] > 1}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(hit)


def decontaminated(text: str | None, items: list, window: int = 10) -> tuple:
    own = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    parts = own.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item, content in items:
        other = own.findall((content or "").translate(LOWER))
        for k in range(max(1, len(other) - window + 1) if other else 0):
            w = other[k : k + window]
            for i in range(len(parts) - len(w) + 1):
                if parts[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    ids |= {str(item)} if item is not None else set()
    return len(parts), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)


def _in_order(rows: list[tuple]) -> list[tuple]:
    """By doc_id, null first, else in the order given."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def repeated_bytes(rows: list[tuple], window: int = 100) -> Counter:
    seen, out = set(), []
    for doc, text in _in_order(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - window + 1):
            if data[k : k + window] in seen:
                gone[k : k + window] = [True] * window
            seen.add(data[k : k + window])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, sha(kept)))
    return Counter(out)


def repeated_words(rows: list[tuple], window: int = 20) -> Counter:
    seen, out = set(), []
    for doc, text in _in_order(rows):
        found = words(text)
        gone = [False] * len(found)
        for k in range(len(found) - window + 1):
            if tuple(found[k : k + window]) in seen:
                gone[k : k + window] = [True] * window
            seen.add(tuple(found[k : k + window]))
        kept = " ".join(w for w, g in zip(found, gone, strict=True) if not g)
        out.append((doc, len(found), sum(gone), sha(kept)))
    return Counter(out)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    found = words((text or "").translate(LOWER))
    if not found:
        return 0
    parts = [" ".join(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows: list[tuple], bits: int = 3) -> tuple[list[int], list[int]]:
    """Per row, its fingerprint and a number of its component."""
    prints = [fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return prints, group


def near_duplicates(rows: list[tuple], bits: int = 3) -> Counter:
    prints, group = near_groups(rows, bits)
    least = {}
    for (doc, _), g in zip(rows, group, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return Counter(
        (doc, f"{p:016x}", least.get(g)) for (doc, _), p, g in zip(rows, prints, group, strict=True)
    )


def unigram(rows: list[tuple]) -> tuple[Counter, int, dict]:
    """Training counts, their total, and per row (held_out, n_tokens, n_known, base_score)."""

    def tokens(text):
        return [*words((text or "").translate(LOWER)), None]

    def held(doc):
        return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2

    counts = Counter(t for doc, text in rows if not held(doc) for t in tokens(text))
    total = sum(counts.values())
    below = total + len(counts) + 1
    out = {}
    for doc, text in rows:
        own = tokens(text)
        score = sum(math.log10((counts[t] + 1) / below) for t in own)
        out[doc] = (held(doc), len(own), sum(counts[t] > 0 for t in own), score)
    return counts, total, out
