"""Long texts of any script are encoded in chunks, and as the libraries encode them whole."""

from __future__ import annotations

import random

import pytest

from cueflow.llm import bpe, bpe_codec

ALPHABETS = {
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщыэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "devanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशसह",
    "han": "的一是不了人我在有他这为之大来以个中上们",
    "hangul": "가나다라마바사아자차카타파하",
}


def text_of(script: str, n: int) -> str:
    rnd = random.Random(script)
    out: list[str] = []
    size = 0
    while size < n:
        word = "".join(rnd.choices(ALPHABETS[script], k=rnd.randint(1, 9)))
        if script == "devanagari":
            word = word[0] + "\u093f" + word[1:]
        end = rnd.choice("，。、") if script == "han" else rnd.choice((" ", " ", " ", ". ", ",\n"))
        out.append(word + end)
        size += len(word) + len(end)
    return "".join(out)


@pytest.mark.parametrize("script", sorted(ALPHABETS))
def test_chunks_of_any_script(script):
    text = text_of(script, 640_000)
    seen: list[int] = []

    def encode(s: str):
        seen.append(len(s))
        return bpe.encode_json(s)

    ids = bpe.encode_overlapping(text, encode, bpe.byte_lengths("byte_bpe_50k.tiktoken"))
    assert max(seen) <= 2 * bpe.CHUNK_CHARS and sum(seen) < 1.2 * len(text)
    cuts = bpe_codec.pieces(text)
    assert max(map(len, cuts)) <= 2 * bpe.CHUNK_CHARS and "".join(cuts) == text
    part = text[:100_000]
    assert bpe.encode_overlapping(part, bpe.encode_json, bpe.byte_lengths("byte_bpe_50k.tiktoken"), 3000, 16).tolist() == bpe.json_tokenizer("byte_bpe_50k.json").encode(part, add_special_tokens=False).ids
    assert bpe_codec.encode(part, chunk=3000, overlap=16) == bpe.rank_encoding(bpe_codec.RANKS).encode_ordinary(part)
    assert len(ids) > 1000


def test_mixed_marks_and_contractions():
    rnd = random.Random(3)
    tokens = ["don't", "we’ll", "it's", "'sx", "a-b", "(x)", "1,2", "é́", "字。字", "<|endoftext|>", "x<|", "|>y", "\u180e", "\u200b", "\u00a0", "  ", "\n", "\u0301", "…", "٣a", "a٣"]
    for k in range(60):
        text = "".join(rnd.choices(tokens, k=400))
        assert bpe.encode_overlapping(text, bpe.encode_json, bpe.byte_lengths("byte_bpe_50k.tiktoken"), 50 + k, 3).tolist() == bpe.json_tokenizer("byte_bpe_50k.json").encode(text, add_special_tokens=False).ids
        assert bpe_codec.encode(text, chunk=50 + k, overlap=3) == bpe.rank_encoding(bpe_codec.RANKS).encode_ordinary(text)
