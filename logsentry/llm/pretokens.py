"""Cutting texts into the pieces that byte-pair merges work in, by arrays instead of a regular expression.

Every code point gets a class from a table (space, other white space, letter, number,
anything else). Whether an apostrophe starts a contraction depends on what stands
before it, and a contraction's letters belong to it, so a small automaton runs over the
text. Its step at a code point is a function from four states to four states, packed
into one byte. Functions compose associatively: the text is folded in equal blocks side
by side, the blocks' functions are combined by doubling, and a second pass gives the
state before every code point. Boundaries then follow from classes and states of
neighbours in a few array operations.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

# White space of the pattern, beside the space itself.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
               0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# What may follow an apostrophe in a contraction.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

SPACE, WHITE, LETTER, NUMBER, OTHER = range(5)
SHORT, LONG = 5, 6  # an apostrophe with one or two letters of a contraction behind it

# States before a code point. OPEN: an apostrophe may start a contraction here. RUN: it would be
# absorbed by the space or the run of signs before it. ONE, TWO: so many letters of a contraction to come.
OPEN, RUN, ONE, TWO = range(4)
BLOCK = 512


def _steps() -> np.ndarray:
    """The next state by symbol and state."""
    step = np.zeros((7, 4), np.uint8)
    step[SPACE], step[OTHER], step[SHORT], step[LONG] = RUN, RUN, RUN, RUN
    step[LETTER, TWO] = ONE
    step[SHORT, OPEN], step[LONG, OPEN] = ONE, TWO
    return step


def _pack(f: np.ndarray) -> np.ndarray:
    """Functions of four states, the last axis, as bytes of two bits per state."""
    return (f[..., 0] | f[..., 1] << 2 | f[..., 2] << 4 | f[..., 3] << 6).astype(np.uint8)


@functools.cache
def _tables() -> tuple[np.ndarray, ...]:
    """Class by code point; steps and resetting steps by symbol; composition and application of packed functions."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    step = _steps()
    reset = np.repeat(step[:, :1], 4, axis=1)
    unpacked = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
    compose = _pack(unpacked[np.arange(256)[None, :, None], unpacked[:, None, :]].astype(np.uint8))
    return table, _pack(step), _pack(reset), compose.ravel(), unpacked.T.astype(np.uint8).copy().ravel()


def _states(functions: np.ndarray) -> np.ndarray:
    """The state before each position when ``functions`` are applied in order, from OPEN."""
    _, _, _, compose, apply = _tables()
    n = len(functions)
    rows = max(1, -(-n // BLOCK))
    padded = np.full(rows * BLOCK, 0b11100100, np.uint8)  # the identity
    padded[:n] = functions
    steps = padded.reshape(rows, BLOCK).T.astype(np.int32)  # one column per block
    folded = np.full(rows, 0b11100100, np.int32)
    for f in steps:
        folded = compose[folded * 256 + f].astype(np.int32)
    reach = 1
    while reach < rows:  # inclusive scan of the blocks by doubling
        folded[reach:] = compose[folded[:-reach] * 256 + folded[reach:]]
        reach *= 2
    state = np.zeros(rows, np.int32)
    state[1:] = apply[folded[:-1]]  # OPEN through each block's past
    out = np.empty((BLOCK, rows), np.uint8)
    for k, f in enumerate(steps):
        out[k] = state
        state = apply[state * 256 + f].astype(np.int32)
    return out.T.ravel()[:n]


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True at each code point that starts a piece. ``first`` is true where a text starts."""
    table, step, reset, _, _ = _tables()
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = table[points]
    ends = np.append(first[1:], True)  # the next code point belongs to another text
    after = np.append(points[1:], 0)
    after2 = np.append(after[1:], 0)
    apostrophe = (points == 0x27) & ~ends
    symbol = kind.copy()
    symbol[apostrophe & np.isin(after, [ord(c) for c in ONE_LETTER])] = SHORT
    two = np.zeros(n, bool)
    for a, b in TWO_LETTERS:
        two |= (after == ord(a)) & (after2 == ord(b))
    symbol[apostrophe & two & ~np.append(ends[1:], True)] = LONG
    state = _states(np.where(first, reset[symbol], step[symbol]))

    white = kind <= WHITE
    before = np.empty_like(kind)
    before[0], before[1:] = OTHER, kind[:-1]
    past = np.zeros_like(state)
    past[1:] = state[:-1]
    last_white = ~ends & ~np.append(white[1:], True)  # followed by something else of the same text
    starts = np.where(
        white,
        (before > WHITE) | last_white,
        np.where(before == SPACE, False, kind != before) | ((kind == LETTER) & (past == ONE) & (before == LETTER)),
    )
    starts &= ~((kind == LETTER) & (state >= ONE))
    return starts | first


def slices(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The pieces of all texts in order as UTF-8, and for each text the number of the piece it starts with (one more at the end)."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(lengths)))
    first = np.zeros(len(points), bool)
    first[begin[:-1][lengths > 0]] = True
    at = np.flatnonzero(boundaries(points, first))
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    place = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
    blob = joined.encode("utf-8")
    cuts = place[np.append(at, len(points))].tolist()
    return [blob[a:b] for a, b in zip(cuts, cuts[1:])], np.searchsorted(at, begin)


def in_blocks(texts: list[str], characters: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of whole texts of about so many characters, to bound the arrays held at a time."""
    out, start, held = [], 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= characters:
            out.append((start, i + 1))
            start, held = i + 1, 0
    return out + ([(start, len(texts))] if start < len(texts) else [])
