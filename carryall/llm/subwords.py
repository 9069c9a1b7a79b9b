"""Subword ids of whole texts, each distinct piece of text encoded once per worker.

The tokenizers used here never join what a blank divides, so a text is cut at single
blanks, every piece is looked up among those met before, and the ids, kept as bytes,
are put together. Texts in which a cut would not be safe are encoded whole.
"""

from __future__ import annotations

import gc
import re
import string
import struct
from collections.abc import Callable

import pyarrow as pa

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
# Pieces of a generation. A worker remembers the one it fills and the one before.
_REMEMBERED = 600_000

# Words of more bytes are encoded whenever they come up.
_LONG = 256

# Blanks other than space and line feed; texts with these, with runs of blanks or with blanks
# around them are not cut for byte-level ids. Printable characters hold none of them.
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
# Neither letters, digits nor blanks: behind a letter, a run of them is a pre-token of its own.
_MARKS = string.punctuation
# A mark that often ends a word, alone behind a letter up to U+00FF.
_ENDS = re.compile("[,.;:!?](?<=[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff].)(?=[ \n]|\\Z)")
# Before a piece that no space precedes, of a text that is cut; such texts hold no carriage return.
_START = "\r"
_CONTROL = re.compile("[\x1c-\x1f]")


def tokenizer_path(name: str) -> str:
    """The place of one of the public vocabulary files; an absolute path is kept."""
    if name.startswith("/"):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, int]:
    """The letter that a byte-level vocabulary has for each byte: itself where it prints."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in prints)
    return {b: b for b in prints} | {b: 256 + k for k, b in enumerate(others)}


class _Uncut(Exception):
    """A text is not one that may be cut at its blanks."""


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    """Ids of pieces; a piece that is not there is learned as it is looked up."""

    def __init__(self, learn: Callable[[str], bytes]) -> None:
        self.learn = learn

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.learn(piece)
        return ids


class Encoder:
    """Ids of texts as bytes: unsigned 32-bit numbers, little-endian.

    known, older: ids of pieces. For byte-level ids a piece follows a space, unless it
    is a line feed or starts with _START. A mark that ends a word is a piece of its own,
    so that the word is learned once. Each holds `remembered` pieces (none: _REMEMBERED),
    and at most those of one text more.
    """

    def __init__(self, path: str, remembered: int | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text in a document.
        self.tokenizer.encode_special_tokens = True
        self.lowers = self.tokenizer.normalizer is not None
        self.remembered = remembered
        self.known = _Pieces(self._learned)
        self.older: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.space = chr(self.letters[0x20])
        self.model = self.tokenizer.model
        self.each = [_packed([k]) for k in range(1 + max(self.tokenizer.get_vocab().values()))]
        self.words = Words(self)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is not None:
            return ids
        # Letters up to U+00FF are composed already and lower-cased one by one.
        ascii_only = piece.isascii()
        if ascii_only or max(piece) <= "\xff":
            if piece.isalpha():
                return self._word(piece.lower() if self.lowers else " " + piece, ascii_only)
            if piece in ("", _START):
                # Between two blanks, or a blank and an end of the text.
                raise _Uncut
            core = piece.rstrip(_MARKS)
            if len(core) < len(piece):
                if core[-1:].isalpha():
                    rest = piece[len(core) :]
                    return self.known[core] + self.known[rest if self.lowers else _START + rest]
            elif not self.lowers and piece[0] == _START and piece[1:].isalpha():
                return self._word(piece[1:], ascii_only)
        return self._whole([self._written(piece)])[0]

    def _word(self, text: str, ascii_only: bool) -> bytes:
        """Of letters, which are a single pre-token with the space before them."""
        if not ascii_only:
            text = text.encode().decode("latin-1").translate(self.letters)
        elif text[0] == " ":
            text = self.space + text[1:]
        each = self.each
        return b"".join([each[t.id] for t in self.model.tokenize(text)])

    def _written(self, piece: str) -> str:
        """A piece as it stands in a text."""
        if self.lowers or piece[:1] == "\n":
            return piece
        return piece[1:] if piece[:1] == _START else " " + piece

    def _cut(self, text: str) -> list[str] | None:
        if self.lowers:
            return None if _CONTROL.search(text) else _ENDS.sub(r" \g<0>", text).split()
        if not text.replace("\n", " ").isprintable() and _ODD.search(text):
            return None
        return (_START + _ENDS.sub(r" \r\g<0>", text).replace("\n", " \n \r")).split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = []
        bound = _REMEMBERED if self.remembered is None else self.remembered
        for text in texts:
            pieces = self._cut(text) if text else []
            if pieces is not None:
                if len(self.known) > bound:
                    self.known, self.older = _Pieces(self._learned), self.known
                try:
                    out.append(b"".join(map(self.known.__getitem__, pieces)))
                    continue
                except _Uncut:
                    pass
            out += self._whole([text])
        return out


class Words(dict):
    """Ids of words, as bytes: what ASCII blanks divide, with A-Z lower-cased. For encoders that lower-case.

    A word is encoded as a text of its own as it is looked up first. It and the encoder's
    pieces hold `remembered` (none: _REMEMBERED) together, and those before.
    """

    def __init__(self, enc: Encoder) -> None:
        self.enc = enc
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None and word.isalpha():
            # ASCII letters: one piece.
            ids = self.enc._word(word.decode(), True)
        elif ids is None:
            text = word.decode()
            pieces = self.enc._cut(text)
            if pieces is None:
                ids = self.enc.encode([text])[0]
            else:
                ids = self.enc._learned(pieces[0]) if len(pieces) == 1 else b"".join([self[p.encode()] for p in pieces])
        if len(word) <= _LONG:
            self[word] = ids
        return ids

    def of(self, words: list[bytes]) -> list[bytes]:
        if len(self) + len(self.enc.known) > (_REMEMBERED if self.enc.remembered is None else self.enc.remembered):
            older = dict(self)
            self.clear()
            self.older = older
        return list(map(self.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The encoder of a worker; what it remembers outlives a task, but not another bound."""
    if path not in _ENCODERS or _ENCODERS[path].remembered != remembered:
        _ENCODERS.pop(path, None)
        released()
        _ENCODERS[path] = Encoder(path, remembered)
    return _ENCODERS[path]


def released() -> None:
    """Gives memory back that earlier tasks of this worker have freed, of other operators too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def forget() -> None:
    """Drops what this worker remembers, as it goes on to another operator's tasks."""
    _ENCODERS.clear()
    released()


def forgotten() -> None:
    """The same, in tasks that may find it done."""
    if _ENCODERS:
        forget()
