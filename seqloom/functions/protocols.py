"""Barcode geometry of the library protocols."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Protocol:
    """Where a read holds its barcode and UMI (0-based), and what a barcode match looks at."""

    name: str
    start: int
    size: int
    umi_start: int = 0
    umi_size: int = 0
    ignores_last: bool = False
    trims: bool = False


# Geometry by protocol.
PROTOCOLS = {
    p.name: p
    for p in (
        Protocol("rts", 0, 9, ignores_last=True, trims=True),
        Protocol("scr", 8, 13, 0, 8, ignores_last=True, trims=True),
        Protocol("allseq", 6, 6, 0, 6),
        Protocol("rnatagseq", 0, 8),
    )
}


def protocol(name: str, start: int | None = None, size: int | None = None) -> Protocol:
    """A known protocol, or a ``customized`` one with the geometry given."""
    if name == "customized":
        if start is None or size is None:
            raise ValueError("a customized protocol needs start and size")
        return Protocol(name, start, size)
    return PROTOCOLS[name]
