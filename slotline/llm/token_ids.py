"""Token ids of texts by the public tokenizers, with a memory of the words met.

The tokenizers library does the encoding. Both vocabularies cut a text at single white space
before they merge anything, and a stop or comma off the word before it; so the ids of a text
are those of its words one after the other. Each worker keeps the ids of words up to 24 bytes
in a hash table of flat arrays, looks up all words of a batch at once, and has the library encode
a word it doesn't have. Words that a batch brings beyond the table's room are encoded for that batch. Where white space runs together the pieces of a byte-level
vocabulary depend on their neighbours, and such a text is encoded as it stands. Strings of special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from slotline.llm.textstats import mixed

#: Slots of a worker's table. It starts anew when 5 of 8 are taken, and takes no words when 7 of 8 are, as a search
#: ends at a free slot: a bound on memory, not on results.
SLOTS = 1 << 21

_RUNS = re.compile(r"\s\s")
#: How white space beyond ASCII begins in UTF-8.
_WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_FRONT = 8
_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2E, 0x2C]] = True
_SPACE = np.zeros(256, bool)
_SPACE[9:14] = _SPACE[32] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1] * 300, np.uint64)

_encoders: dict[tuple[str, str], Encoder] = {}


class WordTable:
    """Ids of words by their bytes: three eights of bytes and the length say which word it is."""

    LONGEST = 24

    def __init__(self, slots: int = SLOTS):
        self.slots = slots
        self.pool = np.zeros(1 << 16, np.uint32)
        self.clear()

    def clear(self) -> None:
        self.lanes = np.zeros((3, self.slots), np.uint64)
        self.size = np.zeros(self.slots, np.uint8)
        self.at, self.count = np.zeros(self.slots, np.int32), np.zeros(self.slots, np.uint8)
        self.words, self.used = 0, 0

    def _slot(self, lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
        head, middle, tail = lanes
        spread = head * np.uint64(0x9E3779B97F4A7C15) + middle * np.uint64(0xC2B2AE3D27D4EB4F)
        spread = spread + tail * np.uint64(0x165667B19E3779F9) + size
        return (mixed(spread) & np.uint64(self.slots - 1)).astype(np.int64)

    def find(self, lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slot of each word; -1 for one that isn't there."""
        slot = self._slot(lanes, size)
        out = np.full(len(size), -1, np.int64)
        open_ = np.arange(len(size))
        while len(open_):
            here = slot[open_]
            taken = self.size[here]
            same = taken == size[open_]
            for lane, own in zip(self.lanes, lanes):
                same &= lane[here] == own[open_]
            out[open_[same]] = here[same]
            open_ = open_[(taken > 0) & ~same]
            slot[open_] = (slot[open_] + 1) & (self.slots - 1)
        return out

    def append(self, ids: list[array]) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of each list of ids, put at the end of the pool."""
        count = np.array([len(x) for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(2 * (self.used + len(flat)), np.uint32)])
        self.pool[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(count) - count
        self.used += len(flat)
        return at, count

    def add(self, lanes: np.ndarray, size: np.ndarray, ids: list[array]) -> None:
        """Keep words that aren't there, each once."""
        at, count = self.append(ids)
        slot, open_ = self._slot(lanes, size), np.arange(len(size))
        while len(open_):
            free = open_[self.size[slot[open_]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            chosen = free[first]
            here = slot[chosen]
            self.lanes[:, here], self.size[here] = lanes[:, chosen], size[chosen]
            self.at[here], self.count[here] = at[chosen], count[chosen]
            done = np.zeros(len(size), bool)
            done[chosen] = True
            open_ = open_[~done[open_]]
            slot[open_] = (slot[open_] + 1) & (self.slots - 1)
        self.words += len(size)


class Encoder:
    """Ids of texts, a batch at a time."""

    def __init__(self, path: str):
        # Spark's tasks are what runs in parallel.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.table = WordTable()

    @staticmethod
    def of(kind: str, path: str) -> Encoder:
        """The worker's encoder for a vocabulary whose kind is ``words`` or ``bytes``."""
        if (kind, path) not in _encoders:
            _encoders[kind, path] = {"words": WordEncoder, "bytes": ByteEncoder}[kind](path)
        return _encoders[kind, path]

    def whole(self, texts: list[bytes]) -> list[array]:
        found = self.tokenizer.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)
        return [array("I", x.ids) for x in found]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text's ids start and end among them."""
        table, raw = self.table, [text.encode() for text in texts]
        if not raw:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if table.words > table.slots * 5 // 8:
            table.clear()
        data = bytes(_FRONT) + b"\n".join(raw) + b"\n" + bytes(32)
        sizes = np.array([len(x) for x in raw])
        begin = _FRONT + np.cumsum(sizes + 1) - sizes - 1
        starts, ends, alone = self.words(data, raw, begin, begin + sizes)
        text = np.searchsorted(begin, starts, side="right") - 1
        if alone.any():
            kept = ~alone[text]
            starts, ends, text = starts[kept], ends[kept], text[kept]
        size = ends - starts
        eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        longer, longest = size > 8, size > 16
        lanes = np.zeros((3, len(size)), np.uint64)
        lanes[0] = eights[starts] & _MASKS[np.minimum(size, 8)]
        lanes[1, longest] = eights[starts[longest] + 8]
        lanes[2, longer] = eights[ends[longer] - 8]
        fits = size <= table.LONGEST
        size = np.where(fits, size, 0).astype(np.uint8)
        # Words that don't fit have size 0, which is no slot's.
        slot = table.find(lanes, size)
        slot[~fits] = -1
        missing = np.flatnonzero((slot < 0) & fits)
        if len(missing):
            first = self._once(lanes[:, missing], size[missing])
            new = missing[first][: table.slots * 7 // 8 - table.words]
            table.add(lanes[:, new], size[new], self.whole([data[a:b] for a, b in zip(starts[new], ends[new])]))
            slot[missing] = table.find(lanes[:, missing], size[missing])
        at, count = table.at[slot].astype(np.int64), table.count[slot].astype(np.int64)
        # Long words, words without room, and texts encoded as they stand, are put behind the pool for this batch only.
        kept = table.used
        long = np.flatnonzero(slot < 0)
        at[long], count[long] = table.append(self.whole([data[a:b] for a, b in zip(starts[long], ends[long])]))
        apart = np.flatnonzero(alone)
        apart_at, apart_count = table.append(self.whole([raw[i] for i in apart]))
        if len(apart):
            text = np.concatenate([text, apart])
            order = np.argsort(text, kind="stable")
            text = text[order]
            at, count = np.concatenate([at, apart_at])[order], np.concatenate([count, apart_count])[order]
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        values = table.pool[np.repeat(at - (stop - count), count) + np.arange(total)]
        table.used = kept
        bounds = np.concatenate([[0], np.cumsum(np.bincount(text, count, minlength=len(raw)))]).astype(np.int64)
        return values, bounds

    @staticmethod
    def _once(lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The place of one of each of the words."""
        order = np.lexsort((*lanes, size))
        lanes, size = lanes[:, order], size[order]
        new = np.ones(len(order), bool)
        new[1:] = (size[1:] != size[:-1]) | (lanes[:, 1:] != lanes[:, :-1]).any(axis=0)
        return order[new]


def _stops(data: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """Where a stop or comma stands between an ASCII letter or digit and an ending."""
    out = np.zeros(len(data), bool)
    out[1:-1] = _STOP[data[1:-1]] & _ALNUM[data[:-2]] & ending[2:]
    return out


class WordEncoder(Encoder):
    """For vocabularies that drop white space and case: words are what stands between ASCII white space."""

    def words(self, data: bytes, raw: list[bytes], begin, end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bytes_ = np.frombuffer(data, np.uint8)
        space = _SPACE[bytes_]
        space[:_FRONT] = True
        space[end[-1] :] = True
        stop = _stops(bytes_, space)
        starts = np.flatnonzero(~space[1:] & (space[:-1] | stop[1:])) + 1
        ends = np.flatnonzero(~space[:-1] & (space[1:] | stop[1:])) + 1
        return starts, ends, np.zeros(len(raw), bool)


class ByteEncoder(Encoder):
    """For byte-level vocabularies, where a blank belongs to the word behind it."""

    def words(self, data: bytes, raw: list[bytes], begin, end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bytes_ = np.frombuffer(data, np.uint8)
        space = _SPACE[bytes_]
        line = bytes_ == 10
        between = np.zeros(len(bytes_), bool)
        between[end] = True
        # Texts where white space follows white space, other than the line ends put between them.
        inside = space & ~between
        runs = np.flatnonzero(inside[1:] & inside[:-1])
        alone = np.zeros(len(raw), bool)
        alone[np.searchsorted(begin, runs, side="right") - 1] = True
        for at, text in enumerate(raw):
            if not alone[at] and not text.isascii() and any(x in text for x in _WIDE_SPACE):
                alone[at] = bool(_RUNS.search(text.decode()))
        first = line | (bytes_ == 32) | _stops(bytes_, line | (bytes_ == 32))
        first[1:] |= line[:-1]
        first[:_FRONT] = False
        first[begin[0]] = True
        starts = np.flatnonzero(first[: end[-1] + 1])
        ends = np.append(starts[1:], end[-1] + 1)
        real = ~between[starts]
        return starts[real], ends[real], alone
