"""Merge lists and word splitting of tokenizer files, without training anything.

Splitting follows the file: special strings first, then the normaliser, then
the splitting pattern. Ordinary characters take a compiled pattern here; a text
with any other character goes through the library's own splitter, since its
character tables may be of another Unicode version.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import regex
from tokenizers import Tokenizer

#: Characters whose class is the same in all Unicode versions in use.
_OTHER = re.compile(
    r"[^\x00-\x1b\x20-\u02FF\u0391-\u03A1\u03A3-\u03CE\u0400-\u0481\u2010-\u2027"
    r"\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]")
_RUN_BEFORE_BLANK = re.compile(r"\s ")
_BLANKS_AND_WORD = re.compile(r"\s*\S+|\s+")


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself where
    printable, else the next free one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


#: Bits of an id or rank.
PACK = 20


class Vocabulary:
    """One tokenizer file.

    ``pairs`` maps (left id, right id) to (rank, merged id); ``packed`` is the same
    with each pair as one number, ``left << PACK | right`` to ``rank << PACK | merged``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.pairs[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.packed = {left << PACK | right: rank << PACK | merged
                       for (left, right), (rank, merged) in self.pairs.items()}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.names = {number: name for name, number in
                      [*self.ids.items(), *self.special.items()]}
        self.byte_level_decoder = (content.get("decoder") or {}).get("type") == "ByteLevel"
        self.letters = byte_letters()
        self.byte_of = {letter: number for number, letter in enumerate(self.letters)}
        self.tokenizer = Tokenizer.from_file(path)
        self._special = regex.compile(
            "|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)))
        splitter = content["pre_tokenizer"]
        self._lower = content["normalizer"] is not None
        parts = splitter.get("pretokenizers", [splitter])
        pattern = next((p["pattern"]["Regex"] for p in parts if p["type"] == "Split"),
                       BYTE_LEVEL_PATTERN)
        self._keeps_blanks = pattern == BYTE_LEVEL_PATTERN
        self.split_chunk = regex.compile(pattern).findall

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, stretch) of a text, special strings taken out first."""
        done = 0
        for match in self._special.finditer(text):
            if match.start() > done:
                yield False, text[done:match.start()]
            yield True, match.group()
            done = match.end()
        if done < len(text):
            yield False, text[done:]

    @staticmethod
    def is_ordinary(stretch: str) -> bool:
        """Whether all character tables in use agree on the stretch."""
        return not _OTHER.search(stretch)

    def chunks(self, stretch: str) -> list[str] | None:
        """Stretches that split into words alone as they do together, for a cache.

        None if a character is not ordinary. A chunk is a non-blank run, with
        the blanks before it where the pattern keeps blanks.
        """
        if not self.is_ordinary(stretch):
            return None
        # None of these characters composes with another, so NFC changes nothing;
        # a final sigma is an ordinary one here.
        if self._lower:
            stretch = stretch.replace("\u03A3", "\u03C3").lower()
        if not self._keeps_blanks:
            return stretch.split()
        if _RUN_BEFORE_BLANK.search(stretch) or stretch[-1:].isspace():
            return _BLANKS_AND_WORD.findall(stretch)
        first, *others = stretch.split(" ")
        return ([first] if first else []) + [" " + word for word in others]

    def library_words(self, stretch: str) -> list[str]:
        """Words of a stretch by the library's own splitter."""
        normalizer, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normalizer is not None:
            stretch = normalizer.normalize_str(stretch)
        # It gives the letters of the bytes; words are wanted as text.
        return [self.unletter(word) for word, _ in split.pre_tokenize_str(stretch)]

    def unletter(self, word: str) -> str:
        return bytes(self.byte_of[letter] for letter in word).decode("utf-8", "surrogateescape")

    def symbols(self, word: str) -> list[int]:
        """Ids of a word's bytes, the last with the end-of-word suffix."""
        names = [self.letters[b] for b in word.encode("utf-8", "surrogateescape")]
        if names:
            names[-1] += self.suffix
        return [self.ids[name] for name in names]


#: The splitting pattern of the byte-level scheme, a fixed value.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The file's vocabulary, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


class Cache(dict):
    """Results by string. Bounded: long keys are not kept, and a full cache starts anew."""

    def __init__(self, make: Callable[[str], object], most: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key: str):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Lookup:
    """Values of texts, made word by word, joined and remembered by chunk."""

    def __init__(self, vocab: Vocabulary, of_word: Callable[[str], object],
                 of_special: Callable[[str], object], join: Callable[[list], object]):
        self.vocab, self.of_special = vocab, of_special
        self.by_word = Cache(of_word)
        self.by_chunk = Cache(lambda chunk: join(
            [*map(self.by_word.__getitem__, vocab.split_chunk(chunk))]))

    def values(self, text: str) -> list:
        """Values of the chunks, words and special strings of a text, in order."""
        found: list = []
        for special, piece in self.vocab.pieces(text):
            if special:
                found.append(self.of_special(piece))
                continue
            chunks = self.vocab.chunks(piece)
            if chunks is None:
                found += map(self.by_word.__getitem__, self.vocab.library_words(piece))
            else:
                found += map(self.by_chunk.__getitem__, chunks)
        return found


_LOOKUPS: dict[tuple[str, str], object] = {}


def lookup(purpose: str, path: str, make: Callable[[Vocabulary], object]):
    """The worker's lookup of one purpose and file."""
    if (purpose, path) not in _LOOKUPS:
        _LOOKUPS[purpose, path] = make(vocabulary(path))
    return _LOOKUPS[purpose, path]
