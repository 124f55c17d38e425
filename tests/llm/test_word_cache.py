from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from cases import ODD_TEXTS
from tokenizers import Tokenizer

from ledgerloom.llm import word_cache

BITS = [" ", "  ", "\n", " \n", "\n ", "\t", "a", "Bc", "word", "Über", "É", "é", "12", "3", ".", ",%%%", "'s", "'", "don't", "_",
        "\x01", "\x1c", "\x85", " ", " ", "́", "İ", "Σ", "ΑΣ", "東京", "😀", "<|endoftext|>", "K", "\r\n"]


@pytest.mark.parametrize("file, kind", [("byte_bpe_50k.json", word_cache.ByteWords), ("word_bpe_49k.json", word_cache.SpacedWords)])
@pytest.mark.parametrize("remembered", [50, 500_000])
def test_equals_the_tokenizer(monkeypatch, file, kind, remembered):
    monkeypatch.setattr(kind, "most_words", remembered)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    tokenizer.encode_special_tokens = True
    encoder = kind(public_tokenizers.path(file))
    rng = random.Random(7)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(25))) for _ in range(3_000)]
    texts += [text or "" for text in ODD_TEXTS] + ["A b\nC d.\nE f", "word. Word, word\nword", "\n", " \n", "a \n"]
    for at in range(0, len(texts), 60):
        some = texts[at : at + 60]
        ids, counts = encoder.encode(pa.array(some, pa.string()))
        start = 0
        for text, count in zip(some, counts.tolist()):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert ids[start : start + count].tolist() == expected, repr(text)
            start += count
        assert start == len(ids)


def test_a_new_word_does_not_copy_the_others():
    """Words come in every slice; each used to copy all that a worker remembers."""
    encoder = word_cache.ByteWords(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode(pa.array([" ".join(f"w{i}" for i in range(3_000))], pa.string()))
    before = encoder.uses, encoder.lengths, encoder.starts, encoder.ids
    encoder.encode(pa.array(["unheard"], pa.string()))
    assert all(now is then for now, then in zip((encoder.uses, encoder.lengths, encoder.starts, encoder.ids), before))


def test_words_of_letters_are_encoded_without_marks():
    encoder = word_cache.SpacedWords(public_tokenizers.path("word_bpe_49k.json"))
    seen, tokenizer = [], encoder.tokenizer

    class Watched:
        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    encoder.tokenizer = Watched()
    encoder.encode(pa.array(["Straße unheard unheard, café x1"], pa.string()))
    assert "straße unheard café" in seen
    assert not any("unheard" in text and encoder._mark in text for text in seen)


@pytest.mark.parametrize("block", [1, 5, 64])
def test_cuts_by_bytes_where_no_token_reaches_over(monkeypatch, block):
    """Any characters side by side, across the edges of the blocks of bytes looked at together."""
    monkeypatch.setattr(word_cache.ByteWords, "_block", block)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    encoder = word_cache.ByteWords(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(block)
    characters = "aZs1'.,-  \n\t\r\x0b\x1f\x7f\x85\xa0é×÷ÿжß²½\u0301\u0663\u1680\u200a\u200b\u2019\u2028\u205f\u3000東😀"
    texts = ["".join(rng.choices(characters, k=rng.randrange(20))) for _ in range(3_000)]
    ids, counts = encoder.encode(pa.array([None, "", *texts], pa.string())[1:])
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in ["", *texts]]
    assert counts.tolist() == [*map(len, expected)]
    assert ids.tolist() == [i for some in expected for i in some]


def test_punctuation_makes_no_new_words():
    """A word used to be learnt again with whatever punctuation or next line came after it."""
    encoder = word_cache.ByteWords(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode(pa.array(["x unheard, unheard. unheard's unheard!\nx unheard?! unheard: unheard7"], pa.string()))
    assert [word for word in encoder.slots if "unheard" in word] == [" unheard"]
