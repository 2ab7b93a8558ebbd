"""Normalisation of free-form column names."""

from __future__ import annotations

import re

# Names in training files that differ from the stream's.
ALIASES = {
    "flow_bytes_s": "flow_bytes_per_sec",
    "flow_packets_s": "flow_packets_per_sec",
    "average_packet_size": "avg_packet_size",
}


def normalize(name: str) -> str:
    """Lower-case ``[a-z0-9_]`` name: other characters become single underscores, none at the ends."""
    return re.sub(r"[^a-z0-9]+", "_", re.sub(r"[\r\n]", "", name.strip()).lower()).strip("_")


def normalize_all(names: list[str]) -> list[str]:
    """Normalised and aliased names; a name met again gets ``_2``, ``_3``, …"""
    result: list[str] = []
    for name in names:
        base = normalize(name)
        base = ALIASES.get(base, base)
        candidate, n = base, 1
        while candidate in result:
            n += 1
            candidate = f"{base}_{n}"
        result.append(candidate)
    return result
