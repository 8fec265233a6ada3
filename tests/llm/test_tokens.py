import sys
import unicodedata

import numpy as np
import pytest
from tokenizers import Tokenizer

from qloom.llm import tokens as q

TAILS = q._TAIL.decode()


@pytest.fixture(scope="module")
def both():
    encoder, whole = q.Encoder(), Tokenizer.from_file(q.vocabulary_path())

    def check(texts):
        for text in texts:
            got, want = encoder.ids(text).tolist(), whole.encode(text, add_special_tokens=False).ids
            assert got == want, next((w for w in text.split() if encoder.ids(w).tolist() != whole.encode(w, add_special_tokens=False).ids), text)

    return check


def characters():
    return [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] in "LNMPS"]


def test_every_character_before_punctuation(both):
    words = [f"{'' if k % 3 else 'a'}{c}{TAILS[k % len(TAILS)]}" for k, c in enumerate(characters())]
    both([" ".join(words[k : k + 2000]) for k in range(0, len(words), 2000)])


def test_letters_that_change_when_normalised_before_each_mark(both):
    odd = [c for c in characters() if unicodedata.normalize("NFC", c).lower() != c.lower() or len(c.lower()) > 1]
    both([" ".join(f"x{c}{t} {c}{t}{t}" for t in TAILS) for c in odd])


@pytest.mark.parametrize("n", range(4))
def test_random_words(both, n):
    rng = np.random.default_rng(n)
    alphabet = list("abcXYZ09éÉßñÄǅİı'’" + TAILS + "<>|-_/́̇‍ 　漢字नि।؟") + ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", " ", "\n"]
    both(["".join(rng.choice(alphabet, rng.integers(1, 30))) for _ in range(3000)])


@pytest.mark.parametrize("word", ["<|ENDOFTEXT|>", "<|EndOfText|>.", "x<|STARTOFTEXT|>y", "<|endoftext|>", "a<|endoftext|>.", "<|endoftext|", "ড়*", "İ.", "é.", "יִ!"])
def test_named_cases(both, word):
    both([word, word.upper(), f"{word} {word}", word * 3])


def test_sentences_of_other_scripts_end_too():
    encoder = q.Encoder()
    ends, marks = encoder.sentence_ends(), encoder.sentence_marks()
    for mark in q.SENTENCE_MARKS + [".", "!", "?", "?!"]:
        ids = encoder.ids(mark)
        assert (len(ids) == 1 and ends[ids[0]]) or any(m.tolist() == ids.tolist() for m in marks)
    assert not ends[encoder.ids("word")].any() and not ends[encoder.ids(",")].any()
