"""Token ids of whole texts by a tokenizers file, with a word cache.

Both kinds of vocabulary used here split a text at white space before they
merge, so a text's ids are the ids of its pieces in order.  A text whose only white
space is blanks and line breaks is cut into pieces that never share a token;
equal pieces are encoded once per worker.  A piece of Latin letters and closing
signs is two pre-tokens and goes straight to the vocabulary's merges, any other
piece through the whole tokenizer, and a text with other white space is encoded whole.
A special token written in a text (``<|endoftext|>``) has no white space, lies inside one piece and
is one id.  The result equals ``encode(text, add_special_tokens=False)`` (see the tests).
"""

from __future__ import annotations

import os
import re
from itertools import chain

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_OTHER_SPACE = re.compile(r"[^\S \n]")
_SIMPLE = re.compile(r"( ?)([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)")
_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+\Z")
CACHE_ENTRIES = 1 << 20
LONGEST_CACHED = 48


def _byte_signs() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself where it is
    printable, else the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


_SIGNS = _byte_signs()
_WRITTEN = {c: "".join(_SIGNS[b] for b in chr(c).encode()) for c in (32, *range(0xC0, 0x100))}


class Encoder:
    """``spaces``: pieces keep the blank before them (byte-level vocabularies);
    otherwise white space is dropped (word-end vocabularies).  ``entries``: pieces that the
    cache holds at most."""

    def __init__(self, path: str, spaces: bool, end: int, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaces, self.end, self.entries = spaces, end.to_bytes(4, "little"), entries
        self.cache: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if _OTHER_SPACE.search(text):
            return [text]
        if not self.spaces:
            return text.split()
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text:
            return _PIECE.findall(text)
        return text.replace(" ", "\x1f ").replace("\n", "\x1f\n\x1f").split("\x1f")

    def _merged(self, pre_token: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(pre_token.translate(_WRITTEN))])

    def _piece(self, piece: str) -> bytes:
        m = _SIMPLE.fullmatch(piece)
        if not m or len(piece) > LONGEST_CACHED:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            return b"".join([i.to_bytes(4, "little") for i in ids])
        space, letters, signs = m.groups()
        out = self._merged(space + letters if self.spaces else letters.lower())
        if signs:
            if signs not in self.signs:
                self.signs[signs] = self._merged(signs)
            out += self.signs[signs]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids and the end id, little-endian unsigned 32-bit."""
        split = [self.pieces(t) if t else [] for t in texts]
        new = set(chain.from_iterable(split)).difference(self.cache)
        if len(self.cache) + len(new) > self.entries:
            self.cache.clear()
            self.signs.clear()
            new = set(chain.from_iterable(split))
        cache, passing = self.cache, {}
        for p in new:
            (cache if len(p) <= LONGEST_CACHED else passing)[p] = self._piece(p)
        if passing:
            get = lambda p: cache[p] if p in cache else passing[p]
        else:
            get = cache.__getitem__
        return [b"".join(map(get, s)) + self.end for s in split]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, spaces: bool, end: int, entries: int = CACHE_ENTRIES) -> Encoder:
    """The worker's encoder for a vocabulary file (kept between tasks)."""
    key = (path, spaces, end, entries)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
