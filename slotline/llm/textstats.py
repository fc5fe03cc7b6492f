"""Word positions, word hashes and rule statistics of one text, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+``. Hashes are 64-bit values of a word's UTF-8 bytes:
differences of a prefix polynomial, so that all words of a text are hashed at once.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SYMBOLS = b"#*$%&|<>"


def _tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < length:
        size = max(length, 1 << 16)
        for at, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0][:length], _powers[1][:length]


def mixed(values: np.ndarray) -> np.ndarray:
    """The 64-bit values with their bits spread."""
    x = values ^ (values >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes."""
    inside = np.ones(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each span of bytes; equal bytes have equal hashes wherever they stand."""
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return span_hashes(data, *words(data)) if len(data) else np.zeros(0, np.uint64)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words; of all words if there are fewer, none if none."""
    width = min(width, len(hashes))
    if not width:
        return hashes
    count = len(hashes) - width + 1
    total = np.zeros(count, np.uint64)
    for at in range(width):
        total = total * _BASE + hashes[at : at + count]
    return mixed(total)


def repeated(keys: np.ndarray) -> np.ndarray:
    """For each key, how often it occurs."""
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[place]


#: What ``rule_statistics`` returns, in order.
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_same_next", "n_distinct", "n_upper", "n_marks", "n_digits", "n_bars",
)


def rule_statistics(text: str | None) -> tuple[int, ...]:
    """The counts in ``STATISTICS`` of the whole text; all 0 for null."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    starts, ends = words(data)
    n_words = len(starts)
    if not n_words:
        return (0,) * len(STATISTICS)
    per_byte = np.bincount(data, minlength=256)
    spaces = int(per_byte[32] + per_byte[9:14].sum())
    word_chars = len(raw) - int(per_byte[0x80:0xC0].sum()) - spaces
    lines = [line for line in text.split("\n") if line.strip(" \t\n\r\x0b\x0c")]
    hashes = span_hashes(data, starts, ends)
    covered = 0
    if n_words >= 3:
        found_twice = repeated(shingle_hashes(hashes, 3)) > 1
        hit = np.zeros(n_words, bool)
        for at in range(3):
            hit[at : n_words - 2 + at] |= found_twice
        covered = int(hit.sum())
    letters = per_byte[0x41:0x5B].sum()
    return (
        n_words,
        word_chars,
        int(sum(per_byte[c] for c in SYMBOLS)),
        len(lines) - len(set(lines)),
        covered,
        len(lines),
        int((hashes[1:] == hashes[:-1]).sum()),
        len(np.unique(hashes)),
        int(letters),
        int(per_byte[0x21] + per_byte[0x3F]),
        int(per_byte[0x30:0x3A].sum()),
        int(per_byte[0x7C]),
    )
