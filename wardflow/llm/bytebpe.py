"""Token ids of whole texts as the ``tokenizers`` library gives them, in bulk.

The library's byte-level model first cuts a text into pre-tokens and then
encodes each by itself, so a text's ids are the concatenated ids of its
pre-tokens. Invented or natural, a corpus repeats its pre-tokens: this module
cuts whole Arrow batches with array operations, hands each *distinct* pre-token
to the library once, and puts the ids together again.

Texts that hold one of the vocabulary's special strings, or a character outside
the range for which the cut is known to agree with the library's, are encoded
by the library itself.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa

from wardflow.llm.common import span_hashes, text_buffer

#: Characters up to here are cut by this module (checked against the library in
#: the tests), texts with others go to the library as they are.
KNOWN = 0x540
#: Longest part of a text given to the library or the cutter at once; parts end
#: where a word does, which is always a border between tokens.
PART_CHARS = 1 << 18
#: Bytes of neighbouring texts cut at once.
RUN_BYTES = 1 << 21
#: Distinct pre-tokens remembered per Python worker.
REMEMBER = 1 << 19

_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
_WHITE = {0x85, 0xA0, 0x1680, *range(0x09, 0x0E), 0x20}


def _kind(c: int) -> int:
    if c in _WHITE:
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER)


def safe_parts(text: str, most: int = PART_CHARS) -> list[str]:
    """Cut a long text before white space that follows something else. No
    pre-token crosses such a place, so the parts' tokens are the text's."""
    if len(text) <= most:
        return [text]
    parts, at = [], 0
    while len(text) - at > most:
        cut = next((i for i in range(at + most, at, -1) if text[i].isspace() and not text[i - 1].isspace()
                    and ord(text[i]) not in range(0x1C, 0x20)), 0)
        if not cut:  # one unbroken run: go on to its end
            cut = next((i for i in range(at + most + 1, len(text)) if text[i].isspace() and not text[i - 1].isspace()
                        and ord(text[i]) not in range(0x1C, 0x20)), len(text))
        parts.append(text[at:cut])
        at = cut
    return [*parts, text[at:]] if at < len(text) else parts


class Encoder:
    """One vocabulary file, loaded once per Python worker."""

    _loaded: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [str(t) for t in (x.content for x in self.library.get_added_tokens_decoder().values())]
        self.kinds = np.fromiter((_kind(c) for c in range(KNOWN)), np.uint8, KNOWN)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.places = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)

    def _direct(self, text: str) -> np.ndarray:
        parts = safe_parts(text)
        got = [np.asarray(e.ids, np.uint32) for e in self.library.encode_batch(parts, add_special_tokens=False)]
        return np.concatenate(got) if got else np.zeros(0, np.uint32)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of all texts of a column; null is empty."""
        data, offsets = text_buffer(column)
        n = len(offsets) - 1
        wide = data >= 0xD5  # first bytes of characters from KNOWN on
        odd = np.zeros(n, bool)
        if wide.any():
            odd[np.unique(np.searchsorted(offsets, np.flatnonzero(wide), "right") - 1)] = True
        if self.special:
            raw = data.tobytes()
            for s in self.special:
                at = raw.find(s.encode())
                while at >= 0:
                    odd[np.searchsorted(offsets, at, "right") - 1] = True
                    at = raw.find(s.encode(), at + 1)
        out: list[np.ndarray] = []
        sizes = np.zeros(n, np.int64)
        at = 0
        while at < n:  # runs of texts, each run bounded in bytes
            if odd[at]:
                ids = self._direct(data[offsets[at]:offsets[at + 1]].tobytes().decode())
                out.append(ids)
                sizes[at] = len(ids)
                at += 1
                continue
            end = at + 1
            while end < n and not odd[end] and offsets[end + 1] - offsets[at] <= RUN_BYTES:
                end += 1
            if end == at + 1 and offsets[end] - offsets[at] > RUN_BYTES:
                for part in safe_parts(data[offsets[at]:offsets[end]].tobytes().decode()):
                    raw = np.frombuffer(part.encode(), np.uint8)
                    ids, _ = self._bulk(raw, np.asarray([0, len(raw)]))
                    out.append(ids)
                    sizes[at] += len(ids)
            else:
                ids, counts = self._bulk(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at])
                out.append(ids)
                sizes[at:end] = counts
            at = end
        flat = np.concatenate(out) if out else np.zeros(0, np.uint32)
        return flat, np.concatenate(([0], np.cumsum(sizes)))

    def _bulk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte of each character
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        first = np.searchsorted(lead, offsets)  # each text's first character
        borders = self._cut(chars, first)
        starts = lead[borders]
        ends = np.concatenate((starts[1:], [len(data)]))
        places = self._places(data, starts, ends)
        lengths = self.bounds[places + 1] - self.bounds[places]
        total = int(lengths.sum())
        step = np.repeat(self.bounds[places] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        ids = self.ids[step + np.arange(total)]
        per = np.concatenate(([0], np.cumsum(lengths)))
        at = np.searchsorted(starts, offsets)
        return ids, per[at[1:]] - per[at[:-1]]

    def _cut(self, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Character positions at which a pre-token begins. The fixed rule of
        byte-level models: contractions; letters, digits or others with one
        leading space; white space without its last before more text."""
        n = len(chars)
        kind = self.kinds[np.minimum(chars, KNOWN - 1)]
        edge = np.zeros(n + 1, bool)
        edge[first] = True
        turn = np.ones(n, bool)
        turn[1:] = (kind[1:] != kind[:-1]) | edge[1:-1]
        space = kind == _SPACE
        begin = turn.copy()
        # the last white space of a run stands apart if text follows in the same document ...
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & turn[1:] & ~edge[1:-1]
        begin |= last
        # ... and if it is a plain space it belongs to what follows
        joined = np.flatnonzero(last & (chars == 0x20)) + 1
        begin[joined] = False
        # contractions: an apostrophe alone, not joined to a space, and then letters
        mark = np.flatnonzero((chars == 0x27) & begin & turn)
        mark = mark[(mark + 1 < n)]
        mark = mark[turn[mark + 1] & (kind[mark + 1] == _LETTER) & ~edge[mark + 1]]
        if len(mark):
            one = chars[mark + 1]
            two = np.where((mark + 2 < n), chars[np.minimum(mark + 2, n - 1)], 0)
            two = np.where(edge[np.minimum(mark + 2, n)], 0, two)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.zeros(len(mark), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (one == ord(a)) & (two == ord(b))
            for size, which in ((1, short), (2, long)):
                m = mark[which]
                begin[m + 1] = False
                after = m + 1 + size
                keep = after < n
                begin[after[keep]] = True
        return np.flatnonzero(begin)

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each pre-token's ids stand, after encoding those not yet known."""
        keys, back = np.unique(span_hashes(data, starts, ends), return_inverse=True)
        if len(self.keys) > REMEMBER:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        places = np.zeros(len(keys), np.int64)
        places[known] = self.places[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            one = np.zeros(len(keys), np.int64)
            one[back] = np.arange(len(starts))
            raw = data.tobytes()
            words = [raw[starts[i]:ends[i]].decode() for i in one[new].tolist()]
            got = [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)]
            sizes = np.fromiter((len(g) for g in got), np.int64, len(got))
            places[new] = np.arange(len(new)) + len(self.bounds) - 1
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
            self.ids = np.concatenate((self.ids, np.fromiter((i for g in got for i in g), np.uint32, int(sizes.sum()))))
            self.keys, self.places = np.insert(self.keys, at[new], keys[new]), np.insert(self.places, at[new], places[new])
        return places[back]


def digest(ids: np.ndarray) -> int:
    """CRC-32 of ids as unsigned little-endian 32-bit values."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())

