"""Token ids of whole texts, from a vocabulary file of the ``tokenizers`` library.

The byte-level vocabulary cuts a text at every place where white space follows other text, so a text's ids are
the ids of its words, each with the space before it. Words repeat, so their ids are kept per Python worker and
the library merges each of their parts once. What is kept is held in two generations: words met again move to the younger
one, and the older is dropped when that is full, so words seen once leave and common ones stay. Texts whose spacing is
unusual, or that hold the name of an added token, go through the library whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np

# Up to so many words are kept per worker in both generations, each up to so many characters.
KNOWN_WORDS = 600_000
KNOWN_CHARS = 48
END_ID = 0
# Printable ASCII, the line feed, and letters up to U+167F: among these, only space and line feed are white space.
_UNUSUAL = re.compile("[^\n !-~¡-ᙿ]")


def default_tokenizer() -> str:
    """Path of the public byte-level vocabulary that is installed beside the library."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# The byte-level vocabulary's own cutting of words, for the letters and marks whose kind both patterns agree on.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(f"[\n !-~{_LETTERS}]*")
_PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_PART = re.compile(f"[{_LETTERS}]+")
_END_SIGNS = frozenset(".,;:!?")


def _one_part(word: str) -> bool:
    return word.isalpha() and (word.isascii() or _PART.fullmatch(word) is not None)


def _byte_signs() -> dict[int, str]:
    """The sign a byte-level vocabulary writes for each byte: itself where it shows, else one after U+0100, in turn."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Kept(dict):
    """Ids of words by word, the younger generation; ``_older`` is the one before."""

    def __init__(self):
        super().__init__()
        self._older: dict[str, bytes] = {}

    def _ids(self, word: str) -> bytes:
        raise NotImplementedError

    def __missing__(self, word: str) -> bytes:
        ids = self._older.pop(word, None)
        if ids is None:
            ids = self._ids(word)
            if len(word) > KNOWN_CHARS:
                return ids
        if len(self) >= KNOWN_WORDS // 2:
            self._older = self.copy()
            self.clear()
        self[word] = ids
        return ids


class _Parts(_Kept):
    """Ids of the parts that the vocabulary cuts words into; each is merged by the library's model once."""

    def __init__(self, model):
        super().__init__()
        self._model, self._signs = model, _byte_signs()

    def _ids(self, part: str) -> bytes:
        # Of the ASCII signs a part may hold, only the space and the line feed are written otherwise.
        plain = part.isascii() and "\n" not in part
        written = part.replace(" ", "Ġ") if plain else part.encode().decode("latin-1").translate(self._signs)
        return array("I", [token.id for token in self._model.tokenize(written)]).tobytes()


class _Words(_Kept):
    """Ids of words with ``lead`` before them, or, with ``starts``, of a line feed and the word that starts a line."""

    def __init__(self, tokenizer, parts: _Parts, lead: str, starts: _Words | None = None):
        super().__init__()
        self._starts = starts
        self._tokenizer, self._parts, self._lead = tokenizer, parts, lead
        self._merge, self._written = tokenizer.model.tokenize, lead.replace(" ", "Ġ")

    def __missing__(self, word: str) -> bytes:
        # The usual case of the general way, without its calls: a new word of ASCII letters is one part.
        if word.isalpha() and word.isascii() and len(word) <= KNOWN_CHARS and len(self) < KNOWN_WORDS // 2:
            ids = self._older.pop(word, None)
            if ids is None:
                ids = array("I", [token.id for token in self._merge(self._written + word)]).tobytes()
            self[word] = ids
            return ids
        return super().__missing__(word)

    def _ids(self, word: str) -> bytes:
        if self._starts is not None and word[:1] == "\n":
            return self._parts["\n"] + (self._starts[word[1:]] if len(word) > 1 else b"")
        whole = self._lead + word
        # Most words are one part, or one and the sign that ends them; such a part is kept as a word of its own.
        if _one_part(word):
            return self._parts._ids(whole)
        if word[-1:] in _END_SIGNS and _one_part(word[:-1]):
            return self[word[:-1]] + self._parts[word[-1]]
        if _PLAIN.fullmatch(whole):
            parts = self._parts
            return b"".join([parts[p] for p in _PARTS.findall(whole)])
        return array("I", self._tokenizer.encode(whole, add_special_tokens=False).ids).tobytes()


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as the library's ``encode`` without added special tokens.

    Vocabularies that are not byte-level, or that change a text first, get every text whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self._tokenizer = t = Tokenizer.from_file(path)
        self._added = [token.content for token in t.get_added_tokens_decoder().values()]
        by_bytes = isinstance(t.pre_tokenizer, pre_tokenizers.ByteLevel) and not t.pre_tokenizer.add_prefix_space
        self._by_word = by_bytes and t.normalizer is None and isinstance(t.model, models.BPE)
        parts = _Parts(t.model)
        self._first = _Words(t, parts, "")
        self._later = _Words(t, parts, " ", starts=self._first)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self._by_word or "  " in text or "\n " in text or " \n" in text or _UNUSUAL.search(text) or any([name in text for name in self._added]):
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        # A single line feed is a part of its own, so the words beside it are kept like any others; of several in a row, the
        # last is, and they stay within their word.
        if "\n" in text and "\n\n" not in text:
            text = text.replace("\n", " \n")
        first, *later = text.split(" ")
        known = self._later
        head = self._first[first] if first else b""
        return head + b"".join(map(known.__getitem__, later))

    def document(self, text: str | None) -> np.ndarray:
        """Ids of a text (null: empty), followed by the end id."""
        return np.append(np.frombuffer(self.encode(text), "<u4"), np.uint32(END_ID))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    return Encoder(path)
