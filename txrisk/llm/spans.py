"""Spans of a text as (kind, start, end), in code points with the end exclusive."""

import hashlib

Span = tuple[str, int, int]


def listing(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then by the order of ``kinds``, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def clear_of(found: list[Span], taken: list[Span]) -> list[Span]:
    """The spans of ``found``, leftmost first and long ones before short, that touch none of
    ``taken``."""
    kept, ends, i = [], sorted((a, b) for _, a, b in taken), 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        while i < len(ends) and ends[i][1] <= a:
            i += 1
        if i == len(ends) or ends[i][0] >= b:
            kept.append((kind, a, b))
    return kept


def free_of(found: list[Span], taken: list[Span]) -> list[Span]:
    """The spans of ``found``, leftmost first, that touch neither ``taken`` nor each other."""
    kept, last = [], 0
    for kind, a, b in clear_of(found, taken):
        if a >= last:
            kept.append((kind, a, b))
            last = b
    return kept
