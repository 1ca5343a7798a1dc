"""Public tokenizer files applied unit by unit, with worker caches.

Both vocabularies here never join characters across the start of a word, so a
text's ids are the concatenation of its units' ids. A unit is looked up first;
only units that a worker has not met go through the tokenizer library. Caches are
per Python worker and bounded; when one is full, units that are not met again go.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

CACHE_UNITS = 400_000  # most units that a worker remembers
CACHE_CHARS = 48  # longer units are encoded every time

# A space between two non-blank characters always starts a new pre-token.
_STOPS = (".", ",")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def _whole(unit: str) -> bool:
    """Whether the unit neither starts nor ends with white space."""
    return bool(unit) and unit.strip() == unit


@cache
def _tokenizer(path: str):
    """The library's own tokenizer; loaded by workers that meet a special string only."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ByteBpe:
    """Ids of whole texts by a `tokenizers` file, as little-endian 32-bit bytes.

    Units that a worker has not met are merged by `tiktoken` over the same
    vocabulary, which is several times faster on single words; units that hold
    the special string go to `tokenizers` itself. Tests hold both equal.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str, special: str = "<|endoftext|>"):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._path, self._special = path, special
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}  # the units known before those; what is met again moves back

    def _ids(self, text: str) -> bytes:
        if self._special in text:
            ids = _tokenizer(self._path).encode(text, add_special_tokens=False).ids
        else:
            ids = self._merge(text)
        return array("I", ids).tobytes()

    def _new(self, unit: str) -> bytes:
        """Ids of a word that is not known; one stop or comma after a letter is a pre-token of its own."""
        if unit[-1:] in _STOPS and unit[-2:-1].isalpha():
            return (self._known.get(unit[:-1]) or self._ids(" " + unit[:-1])) + self._ids(unit[-1])
        return self._ids(" " + unit)

    def encode(self, text: str) -> bytes:
        known = self._known
        head, *units = text.split(" ")
        found = list(map(known.get, units))
        if None in found or not _whole(head):
            if not _whole(head) or any(not unit or unit.strip() != unit for unit in units if unit not in known):
                head, *units = _SAFE_SPACE.split(text)
                found = list(map(known.get, units))
            for at, ids in enumerate(found):
                if ids is None:
                    unit = units[at]
                    found[at] = ids = known.get(unit) or self._before.get(unit) or self._new(unit)
                    if len(unit) <= CACHE_CHARS and unit.strip() == unit:
                        known[unit] = ids
            if len(known) > CACHE_UNITS // 2:
                self._before, self._known = known, {}
        return self._ids(head) + b"".join(found)


@cache
def byte_bpe(path: str, ranks_path: str, pattern: str) -> ByteBpe:
    """The worker's own encoder for a vocabulary."""
    return ByteBpe(path, ranks_path, pattern)


@cache
def sentence_piece(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


SPACE = "▁"


def marked_words(text: str) -> list[str]:
    """Units of a text under a SentencePiece model without white-space rules.

    Each unit stands for its leading marks and the characters up to the next
    one; the first mark is left out, as the library puts it there itself. So
    `"a  b"` is `["a", " b"]`, `"a "` is `["a", ""]`, and an empty text has none.
    """
    if not text:
        return []
    parts = text.replace(SPACE, " ").split(" ")
    if "" not in parts:
        return parts
    units, blanks = [], 0
    for part in parts[:-1]:
        if part:
            units.append(" " * blanks + part)
            blanks = 0
        else:
            blanks += 1
    units.append(" " * blanks + parts[-1])
    return units
