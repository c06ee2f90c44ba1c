"""Token ids exactly as the tokenizers library gives them, with each distinct piece of text encoded once per worker.

Both vocabularies start a new pre-token at white space, so a text may be cut there and its pieces encoded alone. Pieces
recur; a bounded memory of pieces makes the library's work proportional to the new ones. A text whose white space is not
the plain kind takes a slower cut, and a text that holds a special string goes to the library whole, because special
strings are found before anything is cut.
"""

from __future__ import annotations

import array
import functools
import re
import sys
from collections.abc import Callable, Iterable

import public_tokenizers
import regex
from tokenizers import Tokenizer

#: Unicode White_Space, which is what the vocabularies' patterns mean by white space (fixed values).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_IS_WHITE = re.compile(f"[{WHITE}]")
_CHUNKS = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
_WORDS = re.compile(f"[^{WHITE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
#: The pre-token patterns of the two vocabularies (fixed values, as their files give them).
_BYTE_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_WORD_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Irregular(Exception):
    """The white space of a text is not single blanks and line ends between words."""


class Memory(dict):
    """A bounded dictionary that makes missing values; entries used since the last turn-over survive it."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self._make, self._limit, self._old = make, limit, {}

    def __missing__(self, key):
        value = self._old.pop(key, None)
        if value is None:
            value = self._make(key)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, int]:
    """The public byte-to-letter rule of byte-level vocabularies: printable bytes stay, the others move past 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(moved)}


BYTE_LETTERS = _byte_letters()
_LETTERS = BYTE_LETTERS
_BLANK = chr(_LETTERS[0x20])
_MARKS = frozenset(".,;:!?")
#: Pieces kept by a worker's memory before it turns over; a piece takes about 200 bytes.
LIMIT = 500_000


def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def loaded(name: str) -> Tokenizer:
    """A tokenizer by file name or by path, once per process."""
    return load(name if "/" in name else public_tokenizers.path(name))


class PieceEncoder:
    """A value for every text: the joined values of its pieces.

    ``pre_token`` gives the value of one pre-token in byte letters, ``join`` puts values together in order, and
    ``whole`` is the library on a whole text. ``byte_level`` says whether white space belongs to tokens.
    """

    def __init__(self, tokenizer: Tokenizer, pre_token: Callable[[str], object], join: Callable[[Iterable], object],
                 whole: Callable[[str], object], byte_level: bool):
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self._pre_token = pre_token
        self._pre_tokens = Memory(pre_token, 100_000)
        self._join, self._whole, self._byte_level = join, whole, byte_level
        self._chunk = Memory(self._of_chunk, 100_000 if byte_level else LIMIT)
        self._blank = Memory(self._after_blank, LIMIT)

    def __call__(self, text: str):
        if self._special and self._special.search(text):
            return self._whole(text)
        if not self._byte_level:
            words = _WORDS.findall(text) if _SEPARATORS.search(text) else text.split()
            return self._join(map(self._chunk.__getitem__, words))
        first, *rest = text.replace("\n", " \n").split(" ")
        if first and not _IS_WHITE.match(first[0]) and not _IS_WHITE.match(first[-1]):
            try:
                values = list(map(self._blank.__getitem__, rest))
                return self._join([self._chunk[first], *values])
            except Irregular:
                pass
        return self._join(map(self._chunk.__getitem__, _CHUNKS.findall(text)))

    def _after_blank(self, piece: str):
        """A piece cut off at a blank; one that starts with a line end had no blank before it."""
        word = piece[1:] if piece[:1] == "\n" else piece
        if piece.isascii():
            if piece.isalpha():
                return self._pre_token(_BLANK + piece)
            end = piece[-1:]
            if piece[:-1].isalpha() and end in _MARKS:
                return self._join((self._pre_tokens[_BLANK + piece[:-1]], self._pre_tokens[end]))
        if not word or _IS_WHITE.match(word[0]) or _IS_WHITE.match(word[-1]):
            raise Irregular
        return self._of_chunk(piece if piece[0] == "\n" else " " + piece)

    def _of_chunk(self, chunk: str):
        if not self._byte_level and chunk.isascii() and chunk.isalpha():
            return self._pre_token(chunk.lower())
        if _BEYOND_LATIN.search(chunk):
            return self._whole(chunk)
        found = _BYTE_LEVEL.findall(chunk) if self._byte_level else _WORD_LEVEL.findall(chunk.lower())
        letters = (p if p.isascii() and p.isalpha() else p.encode().decode("latin-1").translate(_LETTERS) for p in found)
        return self._join([self._pre_tokens[p] for p in letters])


def id_bytes(name: str) -> PieceEncoder:
    """Texts to their ids as little-endian 32-bit numbers, without added tokens."""
    tokenizer = loaded(name)
    model = tokenizer.model

    def packed(ids: list[int]) -> bytes:
        data = array.array("I", ids)
        if sys.byteorder == "big":
            data.byteswap()
        return data.tobytes()

    return PieceEncoder(
        tokenizer, lambda p: packed([t.id for t in model.tokenize(p)]), b"".join,
        lambda text: packed(tokenizer.encode(text, add_special_tokens=False).ids), is_byte_level(tokenizer))


def is_byte_level(tokenizer: Tokenizer) -> bool:
    """Whether white space is part of tokens, by trying."""
    return tokenizer.decode(tokenizer.encode("a b", add_special_tokens=False).ids) == "a b" \
        and len(tokenizer.encode(" ", add_special_tokens=False).ids) > 0


@functools.lru_cache(maxsize=4)
def shared_id_bytes(name: str) -> PieceEncoder:
    return id_bytes(name)
