"""Token ids of whole texts, with a bounded cache of chunks.

A byte-level BPE tokenizer first splits a text into pieces and no token spans
two of them.  White space only ever begins a piece, so a cut before a space
that follows something other than white space never changes the result.  Texts
are cut there, and the ids of each distinct chunk are kept in a bounded cache; a chunk
not seen yet is also cut around a lone line end and before a mark that follows
a letter, which are ends of pieces too.  Letters alone, with a space before them or
not, are one piece, which the model takes in the byte-level alphabet.  ``tests/llm`` compares with encoding
whole texts.  Texts in which the string of
an added token may occur are encoded whole."""

from __future__ import annotations

import os
import re
from array import array

from tokenizers import Tokenizer

from ._common import kept

#: Chunks in a worker's cache (about 200 bytes each), half of them from before it was full last.
CACHE = 800_000
#: The same for other chunks and parts of chunks; less in proportion with a smaller cache.
PARTS = 200_000
_CUT = re.compile(r"(?<=\S)(?= )")
_LINE = re.compile(r"(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
_ODD = re.compile(r"\s ")
#: The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and on, in order.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_SPACE = chr(_ALPHABET[32])


class _AfterSpace(dict):
    """Ids of a space and a chunk, by the chunk alone: no string is built for a known one."""

    def __init__(self, chunks: ChunkEncoder, cache: int):
        super().__init__()
        self.chunks, self.old, self.most = chunks, {}, cache // 2

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if chunk.isascii() and chunk.isalpha():  # most new chunks
                ids = array("I", [t.id for t in self.chunks.model.tokenize(_SPACE + chunk)]).tobytes()
            else:
                ids = self.chunks.fresh(" " + chunk)
        if len(self) >= self.most:
            self.old = self.copy()  # what is met again comes back from here; the rest goes next time
            self.clear()
        self[chunk] = ids
        return ids


class ChunkEncoder(dict):
    """Little-endian unsigned 32-bit ids by chunk, filled on first sight."""

    def __init__(self, path: str, cache: int | None = None):
        super().__init__()
        cache = cache or CACHE
        self.after_space, self.most = _AfterSpace(self, cache), PARTS * cache // CACHE
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]

    def fresh(self, chunk: str) -> bytes:
        if "\n" in chunk and len(parts := _LINE.split(chunk)) > 1:
            return b"".join(map(self.__getitem__, parts))
        if len(chunk) > 2 and chunk[-1] in ".,;:!?" and chunk[-2] < "\u0250" and chunk[-2].isalpha():
            head = self.after_space[chunk[1:-1]] if chunk[0] == " " else self[chunk[:-1]]
            return head + self[chunk[-1]]
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha() and max(word) < "\u0250":
            return array("I", [t.id for t in self.model.tokenize(chunk.encode().decode("latin-1").translate(_ALPHABET))]).tobytes()
        return self.whole(chunk)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.fresh(chunk)
        if len(self) >= self.most:
            self.clear()
        self[chunk] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; null counts as empty."""
        if not text:
            return b""
        if any(t in text for t in self.added):
            return self.whole(text)
        if _ODD.search(text):
            return b"".join(map(self.__getitem__, _CUT.split(text)))
        first, *rest = text.split(" ")
        # the first chunk has no leading space; if it is empty, the text begins with one and nothing is lost
        return (self[first] if first else b"") + b"".join(map(self.after_space.__getitem__, rest))


def encoder(path: str, cache: int | None = None) -> ChunkEncoder:
    """The encoder of a tokenizer file, one per Python worker until another operator runs there."""
    held = kept("encoding")
    if (path, cache) not in held:
        held[path, cache] = ChunkEncoder(path, cache)
    return held[path, cache]


def default_tokenizer() -> str:
    """Path of the public byte-level BPE vocabulary installed beside the libraries."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
