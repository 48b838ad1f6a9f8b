"""Byte-level BPE with the public vocabularies: whole texts, long ones in overlapping chunks.

A long text is cut into chunks that overlap. Each chunk is encoded by itself,
and neighbours are spliced at a *proven* boundary: a single space between two
visible characters, or a place between a letter and a mark that is neither
letter, number nor space (no apostrophe, which contractions begin with). The
pre-tokeniser's pattern must start a new match there whatever stands before, so
both encodings have a token edge there and agree on everything after it. The
classes hold for letters of any script, as far as Unicode 3.2 and the version of
this Python agree on them. Where an overlap holds no proven edge that both
encodings share, the overlap is doubled, up to the whole text: a text of
letters alone is one match of the pattern and cannot be cut at all.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Texts of more characters are encoded in chunks of this many.
CHUNK_CHARS = 1 << 16
#: First overlap on either side of a cut.
OVERLAP_CHARS = 256
#: The vocabulary's one added token; the library's default turns its string into its id.
END_OF_TEXT = ("<|endoftext|>", 50256)

#: Characters on whose classes every Unicode version of the libraries agrees.
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-ɏ‐-‧]")


def _class_of(wanted: str, without: str = "") -> str:
    """Character class of the code points whose general categories, in both Unicode versions, begin with one of ``wanted``."""
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    hit = [c for c in range(0x110000) if new(chr(c))[0] in wanted and old(chr(c))[0] in wanted and chr(c) not in without]
    first = [c for k, c in enumerate(hit) if not k or hit[k - 1] != c - 1]
    last = [c for k, c in enumerate(hit) if k + 1 == len(hit) or hit[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True))


@lru_cache(maxsize=None)
def proven_edges() -> re.Pattern:
    """Matches at proven edges. The marks leave out those of the added token's string, which must not be cut."""
    letter, mark, visible = _class_of("L"), _class_of("PSM", "'’" + END_OF_TEXT[0]), _class_of("LNPSM")
    return re.compile(f"(?<=[{visible}]) (?=[{visible}])|(?<=[{letter}])(?=[{mark}])|(?<=[{mark}])(?=[{letter}])")


@lru_cache(maxsize=None)
def ranks_of(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=None)
def rank_encoding(name: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(name), special_tokens={})


@lru_cache(maxsize=None)
def token_bytes(name: str) -> tuple[bytes, ...]:
    """Bytes of each id."""
    ranks = ranks_of(name)
    out = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        out[i] = piece
    return tuple(out)


@lru_cache(maxsize=None)
def byte_lengths(name: str) -> np.ndarray:
    """Bytes of each id, the added token last."""
    return np.array([*map(len, token_bytes(name)), len(END_OF_TEXT[0])], np.int64)


@lru_cache(maxsize=None)
def json_tokenizer(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


def json_ids(text: str, name: str = "byte_bpe_50k.json") -> list[int]:
    """Ids as the tokenizers library gives them for byte_bpe_50k.json.

    The same vocabulary exists as ranks, which a faster library reads. It is
    used where each character's class is beyond doubt; other texts, and texts
    with the added token's string, go through the tokenizers library itself.
    """
    if END_OF_TEXT[0] in text or _PLAIN.search(text):
        return json_tokenizer(name).encode(text, add_special_tokens=False).ids
    return rank_encoding(name.replace(".json", ".tiktoken")).encode_ordinary(text)


def encode_json(text: str, name: str = "byte_bpe_50k.json") -> np.ndarray:
    return np.array(json_ids(text, name), np.uint32)


def _byte_offsets(text: str) -> Callable[[int], int]:
    """Characters before a position -> bytes before it."""
    if text.isascii():
        return lambda i: i
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    upto = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))])
    return lambda i: int(upto[i])


def encode_overlapping(
    text: str,
    encode: Callable[[str], np.ndarray],
    lengths: np.ndarray,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> np.ndarray:
    """Ids of the whole text, encoded chunk by chunk and spliced at proven common edges.

    ``encode`` gives the ids of a piece, ``lengths`` the bytes of each id. Equal
    to ``encode(text)`` by the argument in the module's docstring; a text without
    any proven edge ends as one encoding of all of it.
    """
    n = len(text)
    if n <= chunk:
        return encode(text)
    at = _byte_offsets(text)
    parts: list[np.ndarray] = []
    begin = 0  # a proven edge, or the start
    while begin < n:
        cut, wide = begin + chunk, overlap
        while True:
            left, right = encode_window(text, begin, min(n, cut + wide), encode, lengths, at), None
            if cut + wide >= n:
                parts.append(left[0])
                return np.concatenate(parts)
            lo = max(begin + 1, cut - wide)
            right = encode_window(text, lo, min(n, cut + 2 * wide), encode, lengths, at)
            splice = _common_edge(text, lo, cut + wide, left[1], right[1], at)
            if splice is not None:
                break
            wide *= 2  # alignment failed: widen
        keep = int(np.searchsorted(left[1], at(splice), side="right")) - 1
        parts.append(left[0][:keep])
        begin = splice
    return np.concatenate(parts)


def encode_window(text, lo, hi, encode, lengths, at) -> tuple[np.ndarray, np.ndarray]:
    """Ids of text[lo:hi] and the absolute byte offsets of their edges, the start first."""
    ids = encode(text[lo:hi])
    return ids, np.concatenate([[0], np.cumsum(lengths[ids])]) + at(lo)


def _common_edge(text, lo, hi, left, right, at) -> int | None:
    """The proven edge nearest to the middle of [lo, hi) that both encodings have."""
    edges = [m.start() for m in proven_edges().finditer(text, lo, hi)]
    middle = (lo + hi) // 2
    for e in sorted(edges, key=lambda e: (abs(e - middle), e)):
        b = at(e)
        if all(x[min(np.searchsorted(x, b), len(x) - 1)] == b for x in (left, right)):
            return e
    return None
