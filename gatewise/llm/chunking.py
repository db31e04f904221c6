"""Content-defined chunk borders from a gear rolling hash.

The hash of a position mixes the 32 bytes that end there, each through a
table value shifted by its distance, so a border depends on nearby content
only: an insertion moves borders around itself and nowhere else.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: One 32-bit value per byte value: the first four bytes of the byte's MD5.
GEAR = np.array([int.from_bytes(hashlib.md5(bytes([b])).digest()[:4], "little") for b in range(256)], dtype=np.uint32)


def rolling(data: bytes, window: int = 32) -> np.ndarray:
    """Gear hash at every byte: sum of GEAR[byte] << distance * (32 / window) over
    the last ``window`` (a power of two, at most 32) bytes, modulo 2**32."""
    h = GEAR[np.frombuffer(data, dtype=np.uint8)]
    width, each = 1, 32 // window
    while width < window and len(h) > width:  # each round doubles the window
        h[width:] += h[:-width] << np.uint32(width * each)
        width *= 2
    return h


def low_points(data: bytes, reach: int, window: int = 16) -> np.ndarray:
    """Ends of the chunks of ``data`` (the last one its length) at local minima:
    a chunk ends after a byte whose hash is not above that of the ``reach``
    bytes before it and after it. Of equal minima that stand closer, as in text
    that repeats a short period, those within ``reach`` bytes of the border
    before are passed over; what lies between is whole periods either way.

    Chunks are longer than ``reach`` bytes and about twice as long on average;
    but for such periods, a border depends on the ``window + reach`` bytes
    before it and the ``reach`` bytes after it, on nothing else. Borders closer
    than ``reach`` bytes to either end of the data are left out.
    """
    n = len(data)
    if n > 2 * reach:
        h = rolling(data, window)
        runs, width = h, 1  # minima over the next ``width`` bytes
        while width < reach:
            step = min(width, reach - width)
            runs = np.minimum(runs[:-step], runs[step:])
            width += step
        here = h[reach:n - reach]
        low = (here <= runs[:len(here)]) & (here <= runs[reach + 1:reach + 1 + len(here)])
        ends = np.flatnonzero(low) + reach + 1
        if len(ends) > 1 and np.diff(ends).min() <= reach:
            kept = [int(ends[0])]
            for end in ends[1:].tolist():
                if end - kept[-1] > reach:
                    kept.append(end)
            ends = np.array(kept, dtype=np.int64)
    else:
        ends = np.zeros(0, dtype=np.int64)
    return np.append(ends, n) if n else ends


def borders(data: bytes, bits: int, least: int = 1, most: int = 0) -> list[int]:
    """Ends of the chunks of ``data``, the last one its length.

    A chunk ends where the top ``bits`` bits of the hash are zero (about every
    2**bits bytes), not before ``least`` bytes, and after ``most`` bytes at
    the latest (0: no such limit). No data: no chunk.
    """
    if not data:
        return []
    found = np.flatnonzero(rolling(data) >> np.uint32(32 - bits) == 0) + 1
    if least <= 1 and not most:
        ends = found.tolist()
    else:
        ends, start = [], 0
        for end in [*found.tolist(), len(data)]:
            while most and end - start > most:
                start += most
                ends.append(start)
            if end - start >= least and end < len(data):
                ends.append(end)
                start = end
    if not ends or ends[-1] != len(data):
        ends.append(len(data))
    return ends
