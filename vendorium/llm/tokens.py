"""Token ids of whole texts from a file of the tokenizers library."""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from pathlib import Path
from string import ascii_lowercase, ascii_uppercase, punctuation

import numpy as np

_KNOWN_WORDS = 350_000  # words whose ids a Python worker remembers, and as many of the generation before
_LONG_WORD = 64  # longer words are encoded each time
_PIECE = 1 << 17  # characters whose words are split at once; longer texts are cut at white space
_TAIL = punctuation.replace("'", "")  # an apostrophe and letters can be one piece
_LETTERS = range(ord("A"), 0x530)  # to the end of Cyrillic
_WHITE = re.compile("[ \n\t\r]")


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        cut = _WHITE.search(text, start + _PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def default_vocabulary() -> str:
    """The vocabulary of the registered queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_vocabulary(path: str) -> str:
    """The tokenizer file as text, to be sent to the executors; its size is that of the vocabulary."""
    return Path(path).read_text(encoding="utf-8")


class _Words(dict):
    """Ids of words. One that is not there is taken from the generation before or encoded, and remembered if it is short."""

    def __init__(self, new: Callable[[str, _Words], bytes], old: dict[str, bytes]):
        super().__init__({"": b""})
        self._new, self._old = new, old
        if isinstance(old, _Words):
            old._old = {}  # nothing is looked up there any more

    def __missing__(self, word: str) -> bytes:
        ids = self._old.get(word)
        if ids is None:
            ids = self._new(word, self)
        if len(word) <= _LONG_WORD:
            self[word] = ids
        return ids


class _Library:
    """The tokenizer, and which words it encodes by their parts or by the model alone. It holds no words, so that they are
    freed with the encoder."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(vocabulary)
        self._tail = _TAIL if self._splits_marks() else ""
        lowers = self._tokenizer.normalizer
        self._lowers = lowers is not None and lowers.normalize_str(ascii_uppercase) == ascii_lowercase
        # Small ASCII letters that stay one piece and stay as they are need the model alone.
        self._model = self._tokenizer.model
        self._packed = [struct.pack("<I", number) for number in range(self._tokenizer.get_vocab_size() + 1)]
        one_piece = self._split(ascii_lowercase) == [ascii_lowercase]
        self._direct = self._lowers and one_piece and lowers.normalize_str(ascii_lowercase) == ascii_lowercase and self._of_model(ascii_lowercase) == self.raw(ascii_lowercase)
        self._spelling = self._spellings() if self._direct else {}
        self._spelled = re.compile(f"[{''.join(map(chr, self._spelling))}]+").fullmatch if self._spelling else lambda word: None

    def _split(self, text: str) -> list[str]:
        splits = self._tokenizer.pre_tokenizer
        return [] if splits is None else [piece for piece, _ in splits.pre_tokenize_str(text)]

    def _splits_marks(self) -> bool:
        """Whether marks after letters are a piece of their own, and no added token is made of marks alone."""
        apart = all(self._split("ab" + marks) == ["ab", marks] for marks in (_TAIL, *_TAIL))
        added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        return apart and all(content.strip(_TAIL) for content in added) and self.raw("ab" + _TAIL) == self.raw("ab") + self.raw(_TAIL)

    def _spellings(self) -> dict[int, str]:
        """Latin, Greek and Cyrillic letters, each as the model gets it: normalized and in the tokenizer's bytes. Only those
        that stay within one piece and change nothing beside them; none if they do not give what the tokenizer gives."""
        found = {}
        for code in _LETTERS:
            letter = chr(code)
            if not letter.isalpha() or not unicodedata.is_normalized("NFC", letter):
                continue
            pieces = self._split(f"a{self._tokenizer.normalizer.normalize_str(letter)}a")
            if len(pieces) == 1 and pieces[0][0] == pieces[0][-1] == "a":
                found[code] = pieces[0][1:-1]
        every = "".join(map(chr, found))
        return found if all(self._of_model(word.translate(found)) == self.raw(word) for word in (every, every[::-1])) else {}

    def raw(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _of_model(self, word: str) -> bytes:
        return b"".join([self._packed[token.id] for token in self._model.tokenize(word)])

    @staticmethod
    def _stays_letters(core: str) -> bool:
        """Whether a normalizer leaves letters: some become a letter with a mark, which joins the marks after it."""
        return unicodedata.is_normalized("NFC", core) and core.lower().isalpha()

    def encode_word(self, word: str, known: _Words) -> bytes:
        """The ids of a new word; its parts are taken from `known`."""
        core = word.rstrip(self._tail)
        if not core.isalpha():
            return self.raw(word)
        if core.isascii():
            small = core.lower() if self._lowers else core
            spelled = small if self._direct else None
        else:
            small, spelled = core, core.translate(self._spelling) if self._spelled(core) else None
            if spelled is None and not self._stays_letters(core):
                return self.raw(word)
        if small != word:
            return known[small] + known[word[len(core) :]]
        return self._of_model(spelled) if spelled else self.raw(word)


class WordEncoder:
    """Encode texts word by word, remembering the ids of words.

    For vocabularies that drop white space and never join tokens across it (as `word_bpe_49k.json`), the ids of a
    text are those of its parts between white space, one after the other. The library encodes every part; a part
    seen before is looked up. Results equal those of encoding the whole text.

    Words are remembered in two generations: when the young one is full it becomes the old one, and of that only words
    that are met again are taken over. A word of letters with marks after it takes the ids of both, and one in ASCII
    capitals those of the small letters, where the tokenizer itself splits and lowers so.
    """

    def __init__(self, vocabulary: str, known: int | None = None):
        self._library, self._known = _Library(vocabulary), known
        self._raw = self._library.raw
        self._old: dict[str, bytes] = {}
        self._young = _Words(self._library.encode_word, self._old)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; none for null."""
        return b"".join([self._joined(piece) for piece in _pieces(text or "")])

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text."""
        return map(self.encode, texts)

    def _joined(self, text: str) -> bytes:
        if len(self._young) > (self._known or _KNOWN_WORDS):
            self._old = self._young
            self._young = _Words(self._library.encode_word, self._old)
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self._young.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(vocabulary: str, known: int | None = None) -> WordEncoder:
    """One encoder for each Python worker, vocabulary and number of words to remember, `_KNOWN_WORDS` if none is given."""
    return WordEncoder(vocabulary, known)


def forget() -> None:
    """Drop the encoders and the words they remember. Spark hands Python workers on from one job to the next, so tasks of
    other work begin with this: else they hold those words beside their own memory."""
    encoder.cache_clear()


def ids_of(raw: bytes | Sequence[int]) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u4")


def vocabulary_size(vocabulary: str) -> int:
    """One more than the largest id of the tokenizer file."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_str(vocabulary).get_vocab(with_added_tokens=True).values()) + 1
