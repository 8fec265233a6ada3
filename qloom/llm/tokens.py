"""Token ids of whole texts by a public tokenizer file, read word by word with a bounded memory of words."""

from __future__ import annotations

import re
import struct
import unicodedata

import numpy as np

TOKENIZER = "word_bpe_49k.json"
# words remembered by one task
KNOWN = 400_000
# punctuation that the tokenizer cuts from a letter or digit before it
_TAIL = b".,;:!?%&$#*|"
# marks that end a sentence in scripts other than Latin
SENTENCE_MARKS = "。 ！ ？ ｡ । ॥ ؟ ۔ ։ … ። ፧ ។ ၊ ။ ‼ ⁇ ⁈ ⁉".split()


def vocabulary_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _ends_in_letter(text: str) -> bool:
    """Whether punctuation after the text is a piece of its own: the text ends, as the tokenizer normalises it, in a letter or digit."""
    last = unicodedata.normalize("NFC", text[-8:]).lower()[-1]
    return unicodedata.category(last)[0] in "LN"


class Encoder:
    """ids(text) equals the tokenizer's ids of the whole text, without special tokens.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its words at ASCII
    white space, one after the other. Words are encoded once and remembered, up to a bound; those that are
    met beyond it are encoded anew.
    """

    def __init__(self, path: str | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.packed = [struct.Struct(f"<{n}{self.dtype.char}").pack for n in range(32)]
        self.known: dict[bytes, bytes] = {}
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the byte alphabet of the vocabulary, for the bytes of letters of Latin-1
        self.alphabet = {}
        for c in map(chr, range(0x100)):
            if c.isalpha():
                self.alphabet.update(zip(c.encode(), letters.pre_tokenize_str(c)[0][0]))
        self.tokenize = self.tokenizer.model.tokenize
        self.plain = False
        self.plain = all(map(self._both, ("Straßenfêtes", "Words")))

    def _both(self, probe: str) -> bool:
        """Whether this tokenizer file treats a word of letters as the short way does."""
        self.plain = False
        whole = self._encode(probe.encode())
        self.plain = True
        return self._encode(probe.encode()) == whole

    def _encode(self, word: bytes) -> bytes:
        if self.plain and word.isalpha():  # ASCII letters
            ids = [t.id for t in self.tokenize(word.decode().lower())]
        else:
            text = word.decode()
            if self.plain and text.isalpha() and max(text) < "\u0100":
                # letters of Latin-1 alone are one piece, composed as they are: the vocabulary is asked at once
                ids = [t.id for t in self.tokenize(text.lower().encode().decode("latin-1").translate(self.alphabet))]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        if len(ids) < 32:
            return self.packed[len(ids)](*ids)
        return struct.pack(f"<{len(ids)}{self.dtype.char}", *ids)

    def _keep(self, word: bytes, ids: bytes) -> bytes:
        if len(self.known) < KNOWN:
            self.known[word] = ids
        return ids

    def _learn(self, word: bytes) -> bytes:
        """A word not remembered: its letters and the punctuation at its end are looked up apart, as they often are known."""
        if word.isalpha():  # ASCII letters
            stem, tail = word.lower(), b""
        else:
            # the tokenizer finds its added tokens before it changes any letter
            if b"<|" in word:
                return self._keep(word, self._encode(word))
            stem = word.rstrip(_TAIL)
            tail = word[len(stem) :]
            if stem.isascii():
                if tail and not stem[-1:].isalnum():
                    return self._keep(word, self._encode(word))
                stem = stem.lower()
            elif tail and not _ends_in_letter(stem.decode()):
                return self._keep(word, self._encode(word))
        got = self.known.get(stem)
        if got is None:
            got = self._keep(stem, self._encode(stem))
            return got + self._ending(tail) if tail else got
        # a stem met before: this form of it may come again
        return self._keep(word, got + self._ending(tail) if tail else got)

    def _ending(self, tail: bytes) -> bytes:
        got = self.known.get(tail)
        return got if got is not None else self._keep(tail, self._encode(tail))

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of one text; null and empty texts have none."""
        if not text:
            return np.zeros(0, self.dtype)
        words = text.encode().split()
        parts = list(map(self.known.get, words))
        if None in parts:
            learn = self._learn
            parts = [learn(w) if p is None else p for w, p in zip(words, parts)]
        return np.frombuffer(b"".join(parts), self.dtype)

    def forget(self) -> None:
        """Give the memory back at the end of a task, as its process stays for the next one."""
        import pyarrow

        self.known.clear()
        pyarrow.default_memory_pool().release_unused()

    def sentence_ends(self) -> np.ndarray:
        """For each id whether a sentence may end with it."""
        out = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            if re.fullmatch(r"[.!?]+", token.removesuffix("</w>")):
                out[i] = True
        for ids in map(self.ids, SENTENCE_MARKS):
            if len(ids) == 1:
                out[ids] = True
        return out

    def sentence_marks(self) -> list[np.ndarray]:
        """The marks that end a sentence and take several ids."""
        return [ids for ids in map(self.ids, SENTENCE_MARKS) if len(ids) > 1]
