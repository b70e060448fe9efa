"""64-bit hashes of all words of many texts at once, in numpy.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D, after lower-casing A-Z. Its hash is a
polynomial over randomly mapped bytes modulo 2**64, then mixed. Equal words have equal hashes; two
different words of a corpus share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Bytes hashed at once. Longer texts are cut at white space, so memory doesn't follow a text's length.
SEGMENT = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit integers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _ODD) | np.uint64(1)


_BYTE = constants(256, 1)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, SEGMENT + 1), _powers(_INVERSE, SEGMENT + 1)


def _hash_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of raw, and where they start."""
    up, down = (_UP, _DOWN) if len(raw) <= SEGMENT else (_powers(_BASE, len(raw) + 1), _powers(_INVERSE, len(raw) + 1))
    bytes_ = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[bytes_]
    turn = np.diff(inside)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[bytes_] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts


def _cuts(raw: bytes) -> Iterable[bytes]:
    """raw in pieces of about SEGMENT bytes that end at white space."""
    at = 0
    while len(raw) - at > SEGMENT:
        end = at + SEGMENT
        near = max(raw.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if near <= at:
            later = [x for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (x := raw.find(c, end)) >= 0]
            near = min(later, default=len(raw))
        yield raw[at:near]
        at = near
    yield raw[at:]


def word_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the words of text i are hashes[bounds[i]:bounds[i + 1]]. None counts as empty."""
    found: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if group:
            hashes, starts = _hash_segment(b"\n".join(group))
            ends = np.cumsum([len(x) + 1 for x in group])
            found.append(hashes)
            counts.append(np.diff(np.searchsorted(starts, ends), prepend=0))
            group.clear()
            held = 0

    for text in texts:
        raw = text.encode("utf-8", "surrogatepass").lower() if text else b""
        if len(raw) > SEGMENT:
            flush()
            parts = [_hash_segment(x)[0] for x in _cuts(raw)]
            found.extend(parts)
            counts.append(np.array([sum(map(len, parts))]))
            continue
        if held + len(raw) + 1 > SEGMENT:
            flush()
        group.append(raw)
        held += len(raw) + 1
    flush()
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), bounds.astype(np.int64)


def windows(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of each run of width words; element i covers words i to i + width - 1."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - width + 1, np.uint64)
    for j, factor in enumerate(constants(width, seed)):
        out += hashes[j : j + len(out)] * factor
    return mix(out)
