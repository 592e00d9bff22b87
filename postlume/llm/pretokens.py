"""The splitting of texts before byte-level merges, as a transducer run on chunks side by side.

The pattern (contractions, letters, digits, other signs, each with a space in front, white space)
is a deterministic transducer over character classes: a transition says whether a piece starts at
this character or at the one before. Texts of a batch are one sequence, each closed by an end sign,
cut into chunks of equal length that advance in step. The entry state of a chunk is unknown, so the
chunk is run from every state until all runs meet, which makes its state map; the maps are composed
by a parallel prefix scan, which gives every chunk its entry state; only what lies before the
meeting is run again.
"""

from __future__ import annotations

import sys

import numpy as np

from postlume.llm.spans import ranges
from postlume.llm.worker import once

OTHER, LETTER, DIGIT, SPACE, WHITE, QUOTE, END = range(7)
_LETTERS = {c: 7 + i for i, c in enumerate("strvlemd")}
CLASSES = 15
# Start or after a whole contraction, runs, white space (one or more, the last a space or not), a quote
# that opens a piece, and that with r, v or l.
FRESH, IN_LETTER, IN_DIGIT, IN_OTHER, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE, OPEN, OPEN_R, OPEN_V, OPEN_L = range(12)
STATES = 12
HERE, BEFORE = 1, 2


def _make_classes() -> np.ndarray:
    """Class of each code point; the classes of the pattern itself decide."""
    import regex

    out = np.zeros(0x110001, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (WHITE, r"\s")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    out[0x20], out[0x27], out[0x110000] = SPACE, QUOTE, END
    for c, kind in _LETTERS.items():
        out[ord(c)] = kind
    return out


def classes() -> np.ndarray:
    return once(("classes",), _make_classes)


def _make_machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and what starts, by state and class."""
    to, says = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    opening = {OTHER: IN_OTHER, LETTER: IN_LETTER, DIGIT: IN_DIGIT, SPACE: ONE_SPACE, WHITE: ONE_WHITE, QUOTE: OPEN, END: FRESH}
    for state in range(STATES):
        for kind in range(CLASSES):
            basic = LETTER if kind > END else kind
            target, said = opening[basic], HERE
            if state in (IN_LETTER, OPEN_R, OPEN_V, OPEN_L) and basic == LETTER:
                target, said = IN_LETTER, 0
            elif state == IN_DIGIT and basic == DIGIT:
                said = 0
            elif state == IN_OTHER and basic in (OTHER, QUOTE):
                target, said = IN_OTHER, 0
            elif ONE_SPACE <= state <= MORE_WHITE:
                if basic in (SPACE, WHITE):
                    target, said = (MORE_SPACE if basic == SPACE else MORE_WHITE), 0
                elif basic != END:
                    if state in (ONE_SPACE, MORE_SPACE):
                        target, said = (IN_OTHER if basic == QUOTE else target), 0
                    said |= BEFORE if state in (MORE_SPACE, MORE_WHITE) else 0
            elif state == OPEN:
                if basic in (OTHER, QUOTE):
                    target, said = IN_OTHER, 0
                elif kind > END and "strvlemd"[kind - 7] in "stmd":
                    target, said = FRESH, 0
                elif kind > END and "strvlemd"[kind - 7] in "rvl":
                    target, said = {"r": OPEN_R, "v": OPEN_V, "l": OPEN_L}["strvlemd"[kind - 7]], 0
            if state in (OPEN_R, OPEN_V, OPEN_L):
                closing = _LETTERS["l"] if state == OPEN_L else _LETTERS["e"]
                if kind == closing:
                    target, said = FRESH, 0
                else:
                    said |= BEFORE
            to[state, kind], says[state, kind] = target, said
    return to.reshape(-1), says.reshape(-1)


def _scan(maps: np.ndarray) -> np.ndarray:
    """Prefix compositions of state maps, one for each chunk, by doubling."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.int64), axis=1)
        step *= 2
    return maps


def _starts(kinds: np.ndarray, lanes: int) -> np.ndarray:
    """Whether a piece starts at each place."""
    to, says = once(("machine",), _make_machine)
    n = len(kinds)
    steps = max(1, -(-n // lanes))
    lanes = -(-n // steps)
    grid = np.full(lanes * steps, END, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    said = np.zeros((steps, lanes), np.uint8)
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (lanes, STATES)).copy()
    met = 0
    while met < steps and (maps != maps[:, :1]).any():
        maps = to[maps * np.int64(CLASSES) + grid[met][:, None]]
        met += 1
    state = maps[:, 0]
    for i in range(met, steps):
        at = state * np.int64(CLASSES) + grid[i]
        said[i] = says[at]
        state = to[at]
    if met < steps:
        maps[:] = state[:, None]
    state = np.concatenate([[FRESH], _scan(maps)[:-1, FRESH]]).astype(np.uint8)
    for i in range(met):
        at = state * np.int64(CLASSES) + grid[i]
        said[i] = says[at]
        state = to[at]
    said = said.T.reshape(-1)[:n]
    out = said & HERE == HERE
    out[:-1] |= said[1:] & BEFORE == BEFORE
    return out


def pretokens(texts: list[str], lanes: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with an end sign after each, start and size of each piece, its text."""
    lengths = np.array([len(t) for t in texts], np.int64) + 1
    ends = np.cumsum(lengths) - 1
    points = np.full(int(lengths.sum()), 0x110000, np.uint32)
    inner = np.ones(len(points), bool)
    inner[ends] = False
    points[inner] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    starts = np.flatnonzero(_starts(classes()[points], lanes) | ~inner)
    sizes = np.diff(np.append(starts, len(points)))
    real = inner[starts]
    starts, sizes = starts[real], sizes[real]
    return points, starts, sizes, np.searchsorted(ends, starts)


def strings(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[str]:
    flat = points[ranges(starts, sizes)].tobytes().decode("utf-32-le")
    edge = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return [flat[a:b] for a, b in zip(edge[:-1], edge[1:])]


assert sys.byteorder == "little"
