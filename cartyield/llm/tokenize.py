"""Token ids by the tokenizers library, with a bounded memory of words already encoded."""

from __future__ import annotations

import functools
import os
import struct

import numpy as np

END = 1


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Memory(dict):
    """Remembers the last ``limit`` to twice as many results of ``compute``, the used ones longest."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class _Symbols(dict):
    """What stands for a character in the vocabulary, for ``str.translate``."""

    def __init__(self, split):
        super().__init__()
        self.split = split

    def __missing__(self, point: int) -> str:
        self[point] = symbol = "".join(part for part, _ in self.split(chr(point)))
        return symbol


class TextEncoder:
    """Ids of whole texts as the vocabulary file gives them, without special tokens added.

    What the vocabulary allows is tried out on probes. Where it drops white space, the ids of a text are
    those of its words one after another, and words met before are looked up. Where it also lowers
    letters and parts them from punctuation, words of letters are looked up in lower case and apart from the
    full stop or comma after them, and go to the model without normalizing. Otherwise texts or words are encoded in one piece.
    """

    def __init__(self, path: str, limit: int = 1 << 19):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._encode, self._model = tokenizer.encode, tokenizer.model.tokenize
        self._words = _Memory(self._word, limit)
        encode = self._whole
        self._by_word = encode(" \t\n\v\f\r") == b"" and encode("a b\nc") == encode("a") + encode("b") + encode("c")
        cases = (("Quartz", "quartz"), ("ÉTÉ", "été"), ("Straße", "straße"), ("QUEUE", "queue"))
        self._by_piece = self._by_word and all(
            encode(x + mark) == encode(y) + encode(mark) for x, y in cases for mark in ".,"
        )
        if self._by_piece:
            self._symbols = _Symbols(tokenizer.pre_tokenizer.pre_tokenize_str)
            plain = ("quartz", "the", "internationalisation", "zzzxq", "été", "straße", "ñandú", "ªºµ")
            self._by_model = all(encode(x) == self._piece(x) for x in plain)

    def _whole(self, text: str) -> bytes:
        return np.array(self._encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def _ids(tokens: list) -> bytes:
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    _by_model = True

    def _piece(self, letters: str) -> bytes:
        return self._ids(self._model(letters.translate(self._symbols))) if self._by_model else self._whole(letters)

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self._by_piece:
            mark = text[-1] if text[-1] in ".," else ""
            letters = text[:-1] if mark else text
            # Up to here in Unicode, lower case is one letter for one and there is nothing to compose.
            if letters.isalpha() and max(letters) < "\u0100":
                lower = letters.lower()
                if not mark and lower == text:
                    return self._piece(text)
                ids = self._words[lower.encode()]
                return ids + self._words[mark.encode()] if mark else ids
        return self._whole(text)

    def __call__(self, text: str | None) -> bytes:
        """Ids as unsigned 32-bit little-endian integers; null counts as empty."""
        if not text:
            return b""
        if self._by_word:
            return b"".join(map(self._words.__getitem__, text.encode().split()))
        return self._whole(text)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a vocabulary file, which every machine has at the same path."""
    return TextEncoder(path)


def document_ids(path: str, text: str | None, end: int = END) -> bytes:
    """The ids of a document: its text's, then the end id."""
    return encoder(path)(text) + end.to_bytes(4, "little")
