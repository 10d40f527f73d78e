"""Span digests shared by the scanning operators (code point offsets, end exclusive)."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def joined(spans: list[Span], order: dict[str, int]) -> str:
    """``kind:start:end`` by start, then kind as listed, then end."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])))


def digest(spans: list[Span], order: dict[str, int]) -> str:
    return hashlib.sha256(joined(spans, order).encode()).hexdigest()
