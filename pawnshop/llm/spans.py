"""Spans found in the UTF-8 bytes of texts, reported in code points."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def char_index(data: np.ndarray) -> np.ndarray:
    """Number of characters before each byte position (and at the end)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def rows_with(mask: np.ndarray, off: np.ndarray, least: int = 1) -> np.ndarray:
    """Rows in which at least ``least`` bytes are marked."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return np.flatnonzero(total[off[1:]] - total[off[:-1]] >= least)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def in_order(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Sorted by start, then by the order of ``kinds``, then by end."""
    place = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(place, s["kind"]).alias("place"),
                                                  s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


SPAN = "struct<kind:string,start:int,end:int>"
