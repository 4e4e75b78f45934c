"""Pre-token splitting by the public byte-level pattern, vectorised over a buffer of texts.

The pattern's alternatives depend only on the class of each code point (letter, number,
white space, other), so the piece boundaries of many texts are found with numpy at once:

- a run of one class is a piece, with one blank before it if it has one;
- white space before something else gives its last character up: a blank joins the next
  piece, any other stands alone; white space at the end of a text is one piece;
- an apostrophe that begins a piece takes 's, 't, 're, 've, 'm, 'll or 'd with it.

The classes come from the ``regex`` module, less the letters and numbers of newer Unicode
editions that the tokenizer library does not know: the library itself is asked about every
code point that the interpreter's Unicode tables call unassigned.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import regex
from public_tokenizers import PATTERN

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
_TAILS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _known_by_tokenizers(spec_json: str):
    from tokenizers import Tokenizer
    cut = Tokenizer.from_str(spec_json).pre_tokenizer.pre_tokenize_str
    return lambda c: len(cut("a" + c)) == 1 or len(cut("1" + c)) == 1


def _known_by_tiktoken():
    import tiktoken
    ranks = {bytes([i]): i for i in range(256)}
    for a in b"a1":
        for b in range(256):
            ranks[bytes([a, b])] = len(ranks)
    enc = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda c: any(enc.encode_ordinary(x + c)[0] >= 256 for x in "a1")


def class_table(spec_json: str | None = None) -> np.ndarray:
    """Class of every code point for the ``tokenizers`` library with this tokenizer file, or
    for ``tiktoken`` without one. 1.1 MB: made on the driver and broadcast."""
    every = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000)]
    text = "".join(every)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, p in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        out[[m.start() for m in regex.finditer(p, text)]] = kind
    out[0xD800:0xE000] = OTHER
    known = _known_by_tokenizers(spec_json) if spec_json is not None else _known_by_tiktoken()
    for c in np.flatnonzero(out < SPACE):
        if unicodedata.category(every[c]) == "Cn" and not known(every[c]):
            out[c] = OTHER
    return out


def code_points(buf: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Code points that begin at the positions ``lead`` of valid UTF-8."""
    b = buf[lead]
    cp = b.astype(np.int32)
    wide = np.flatnonzero(b >= 0xC0)
    if len(wide):
        at, first = lead[wide], cp[wide]
        padded = np.concatenate([buf, np.zeros(3, np.uint8)])
        c1, c2, c3 = (padded[at + i].astype(np.int32) & 0x3F for i in (1, 2, 3))
        cp[wide] = np.where(first < 0xE0, (first & 0x1F) << 6 | c1, np.where(
            first < 0xF0, (first & 0x0F) << 12 | c1 << 6 | c2, (first & 0x07) << 18 | c1 << 12 | c2 << 6 | c3))
    return cp


def piece_starts(buf: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions at which the pieces of all texts begin."""
    if not len(buf):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    cls = classes[code_points(buf, lead)]
    n = len(lead)
    begins = np.zeros(n, bool)  # a text begins here
    begins[np.searchsorted(lead, offs[:-1][np.diff(offs) > 0])] = True
    start = np.ones(n, bool)
    start[1:] = cls[1:] != cls[:-1]
    start |= begins
    space = cls == SPACE
    follows = np.zeros(n, bool)  # the same text goes on after this character, with no white space
    follows[:-1] = ~space[1:] & ~begins[1:]
    last_space = np.flatnonzero(space & follows)
    start[last_space] = True
    joins = last_space[buf[lead[last_space]] == 0x20]
    start[joins + 1] = False
    quotes = np.flatnonzero((buf[lead] == 0x27) & start & follows)
    if len(quotes):
        quotes = quotes[cls[quotes + 1] == LETTER]
        raw = buf.tobytes()
        for q in quotes.tolist():
            at = int(lead[q]) + 1
            for tail in _TAILS:
                if raw.startswith(tail, at):
                    k = q + 1 + len(tail)
                    if not begins[q + 1:k].any():
                        start[q + 1:k] = False
                        if k < n:
                            start[k] = start[k] or not begins[k] and cls[k] == LETTER
                        break
    return lead[start]


def pieces(buf: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Pieces of all texts, and the index of each text's first piece (length n + 1)."""
    starts = piece_starts(buf, offs, classes)
    if not len(starts):
        return [], np.zeros(len(offs), np.int64)
    # 0xFF occurs in no UTF-8 text: put before every piece, it lets one split cut them all
    gap = np.zeros(len(buf), np.int64)
    gap[starts] = 1
    marked = np.full(len(buf) + len(starts), 0xFF, np.uint8)
    marked[np.arange(len(buf)) + np.cumsum(gap)] = buf
    return marked.tobytes().split(b"\xff")[1:], np.searchsorted(starts, offs)


class Memo(dict):
    """Value of a piece by ``make``, kept for short pieces in two generations: when the young one
    is full it becomes the old one, from which pieces that are met again come back."""

    def __init__(self, make, limit: int = 1 << 19, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, piece: bytes):
        got = self.old.get(piece)
        if got is None:
            got = self.make(piece)
        self.keep(piece, got)
        return got

    def keep(self, piece: bytes, value) -> None:
        if len(piece) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[piece] = value

    def forget(self) -> None:
        self.clear()
        self.old = {}
