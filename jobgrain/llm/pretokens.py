"""Pre-tokens and byte symbols of tokenizer files, and caches with a bound.

Plain text here means ASCII and the precomposed Latin letters up to U+024F: there normal form C changes nothing, lower
case maps one character to one, and the classes letter, digit and other are character ranges. Everything else takes the
exact Unicode classes of the ``regex`` module.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import islice

import regex

# Unicode white space, as the tokenizers' expressions understand it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPACES = re.compile(f"[{SPACE}]+")
#: Separators of ``str.split`` that are no white space for the tokenizers.
SEPARATORS = re.compile("[\x1c-\x1f]")
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
UNPLAIN = re.compile(f"[^\x00-\x7f{_LATIN}]")

# The two pre-token expressions of the tokenizer files, and the same for plain text.
WORD_EXACT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")
WORD_PLAIN = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LATIN}]+|[0-9]|[^{_LATIN}0-9]+")
#: The words of plain text with white space between them.
WORDS_PLAIN = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LATIN}]+|[0-9]|[^{_LATIN}0-9\t-\r ]+")
BYTE_EXACT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
BYTE_PLAIN = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LATIN}]+| ?[0-9]+| ?[^\t-\r {_LATIN}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


SYMBOLS = byte_symbols()
_OF_BYTES = dict(enumerate(SYMBOLS))


def as_symbols(piece: str) -> str:
    if piece.isascii() and piece.isalnum():
        return piece
    return piece.encode().decode("latin-1").translate(_OF_BYTES)


class BoundedCache(dict):
    """Values made on demand; at the limit the older half goes. Keys above ``longest`` characters are never kept."""

    def __init__(self, make: Callable[[str], object], limit: int, longest: int = 64):
        super().__init__()
        self._make, self._limit, self._longest = make, limit, longest

    def __missing__(self, key: str):
        value = self._make(key)
        if len(key) <= self._longest:
            if len(self) >= self._limit:
                for old in list(islice(self, self._limit // 2)):
                    del self[old]
            self[key] = value
        return value


def special_tokens(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}


def split_special(text: str, special: dict[str, int]) -> Iterator[str]:
    """The text cut at special strings, which stay as parts of their own."""
    if not any(x in text for x in special):
        yield text
        return
    yield from filter(None, re.split("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")", text))


def white_split(text: str) -> list[str]:
    """Parts between white space."""
    if SEPARATORS.search(text):
        return [x for x in SPACES.split(text) if x]
    return text.split()


def lower_form(chunk: str) -> str:
    """Normal form C in lower case, each character on its own."""
    if not UNPLAIN.search(chunk):
        return chunk.lower()
    return "".join([c.lower() for c in unicodedata.normalize("NFC", chunk)])


def words_of(chunk: str) -> list[str]:
    """Pre-tokens of a normalised chunk without white space."""
    if UNPLAIN.search(chunk):
        return WORD_EXACT.findall(chunk)
    return WORD_PLAIN.findall(chunk)
