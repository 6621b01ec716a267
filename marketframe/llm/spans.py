"""Spans (kind, start, end) in code points, and how they are written down."""

import hashlib
from collections.abc import Iterable, Sequence

Span = tuple[str, int, int]


def written(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    """``kind:start:end`` by start, then by the order of ``kinds``, joined by commas."""
    ordered = sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def digest(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    return hashlib.sha256(written(spans, kinds).encode()).hexdigest()


def overlaps(spans: Sequence[Span], start: int, end: int) -> bool:
    return any(a < end and start < b for _, a, b in spans)
