"""Token ids of whole texts in the workers, through the tokenizers library.

For a vocabulary that drops white space, a text's ids are the ids of its
white-space separated chunks, one after the other: no rule of its normaliser,
its split pattern or its merges reaches over white space. So each distinct
chunk is encoded once per worker and is then looked up. Memory is bounded: when
the look-up table is full, it is put aside in the place of the one before it, and
a chunk found there is taken over, so that frequent ones stay known.

A plain chunk, of printable ASCII without apostrophes and of Latin-1 letters,
needs neither normaliser nor split pattern: in lower case its runs of letters,
its single digits and its other runs are the pre-tokens, and only a run that
was not seen before goes through the library's model. Every other chunk, and
every chunk that may hold a special string, goes through the whole library.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

#: Chunks that a worker remembers in each of its two tables.
MEMORY = 1 << 19
#: Characters per step of a very long text.
STEP = 1 << 22

_LOADED: dict[str, object] = {}


def load(path: str):
    """The tokenizer of a ``.json`` file, read once per worker."""
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _LOADED[path] = tok
    return _LOADED[path]


#: Lower-case letters of Latin-1, as in a pattern's brackets.
LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[!-&(-~{LETTERS}]+").fullmatch
_RUNS = re.compile(f"[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+").findall
_WORD = re.compile(f"[{LETTERS}]+").fullmatch


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Chunks(dict):
    """chunk -> its ids as little-endian 32-bit numbers."""

    def __init__(self, tok):
        super().__init__()
        self.aside: dict[str, bytes] = {}
        self.encode, self.merge = tok.encode, tok.model.tokenize
        as_bytes = tok.pre_tokenizer[1].pre_tokenize_str
        self.as_bytes = {ord(c): as_bytes(c)[0][0] for c in map(chr, range(128, 256)) if _WORD(c)}
        self.packed = [_packed([i]) for i in range(max(tok.get_vocab().values()) + 1)]
        self.special = tuple(t.content for t in tok.get_added_tokens_decoder().values())
        self.has_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)").search

    def turn(self) -> None:
        """Begin a new table when this one is full."""
        if len(self) >= MEMORY:
            self.aside = dict(self)
            self.clear()

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.aside.get(chunk)) is not None:
            pass
        elif _WORD(chunk) and not self.has_special(chunk):
            ids = self.run(chunk)
        else:
            lower = chunk.lower()
            if not _PLAIN(lower) or self.has_special(chunk):
                ids = _packed(self.encode(chunk, add_special_tokens=False).ids)
            elif len(runs := _RUNS(lower)) > 1 or lower != chunk:
                ids = b"".join(map(self.__getitem__, runs))
            else:
                ids = self.run(chunk)
        if len(self) < MEMORY:
            self[chunk] = ids
        return ids

    def run(self, run: str) -> bytes:
        """The ids of a run that is one pre-token."""
        tokens = self.merge(run if run.isascii() else run.translate(self.as_bytes))
        return self.packed[tokens[0].id] if len(tokens) == 1 else b"".join([self.packed[t.id] for t in tokens])

    def lowered(self, text: str) -> str:
        """``text`` in lower case where that leaves its ids as they are: in Latin-1 every
        character is lower-cased by itself, as the normaliser does. Else ``text``."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        lower = text.lower()
        return text if self.has_special(lower) else lower


_CHUNKS: dict[str, _Chunks] = {}


def chunk_encoder(path: str) -> Callable[[str | None], bytes]:
    """A function from a text (null: empty) to its ids, 4 bytes each."""
    if path not in _CHUNKS:
        _CHUNKS[path] = _Chunks(load(path))
    chunks = _CHUNKS[path]

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        chunks.turn()
        one_space = chunks.lowered(text).replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(chunks.__getitem__, one_space.split(" ")))

    return encode
