"""The chunked encoder against the tokenizers library on whole texts."""

import random
from array import array

import pytest
from tokenizers import Tokenizer

from salesmart.llm.tokens import JOINED, LONG, Encoder, tokenizer_path

RNG = random.Random(3)
PARTS = ["word", "Word,", "don't", "3rd", "12.5", "(so)", "x)", "end.", "ΟΔΟΣ.", "naïve;", "日本語", "é,", "é.", "́x", "★", "a★b",
         "•", "♥", "…", "😀!", " ", "\t", "\n", "\r\n", "İ", "ſ,", "ß:", "", "\xa0", "x" * LONG, "!?", ",", "#1", "ﬁ.", "​", "ǅ?", "ª)"]
VOCABULARIES = (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True))


@pytest.mark.parametrize("name, drops", VOCABULARIES)
def test_ids_are_those_of_the_library(name, drops):
    plain, enc = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name), drops)
    texts = ["", " ", "  ", "<|endoftext|>", "hello <|endoftext|> world", "a<|startoftext|>b , c", "a\n \nb", "a\n b \n", "x\n ", " \n", "a \xa0 \u3000 b", "<|endoftext", "\ud83d".join("ab").replace("\ud83d", "")]
    texts += [" ".join(RNG.choice(PARTS) for _ in range(RNG.randrange(40))) for _ in range(400)]
    texts += [" ".join(RNG.choice(PARTS) + str(RNG.randrange(10_000)) * RNG.randrange(2) for _ in range(3 * JOINED)) for _ in range(5)]
    texts += ["".join(RNG.choice("ab ,.\n1★") for _ in range(60)) for _ in range(300)]
    want = [array("H", plain.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    for _ in range(2):                                   # from the library, then from the table
        assert [t for t, got, w in zip(texts, enc.ids(texts), want) if got != w] == []
    assert [enc.ids([t])[0] for t in texts[:50]] == want[:50]


@pytest.mark.parametrize("name, drops", VOCABULARIES)
def test_any_character_may_stand_in_a_chunk(name, drops):
    plain, enc = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name), drops)
    texts = [" ".join(f"a{chr(c)}b {chr(c)} x{chr(c)}, {chr(c)}." for c in range(lo, lo + 512) if not 0xD800 <= c < 0xE000)
             for lo in range(1, 0x20000, 512)]
    for t in texts:
        assert enc.ids([t])[0] == array("H", plain.encode(t, add_special_tokens=False).ids).tobytes()
