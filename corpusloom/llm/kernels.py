"""Vectorized text kernels that run inside Arrow batches: words, n-gram hashes, min-wise signatures and public tokenizers.

Words are the maximal runs of letters and digits of the NFKC, lower-cased text; ``_`` belongs to no word and every Han
character is a word of its own.
"""

from __future__ import annotations

import base64
import functools
import math
import re

import numpy as np
import xxhash

from corpusloom.functions.text import nfkc

#: Han letters and numerals.
HAN = "々〇〡-〩〸-〻㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
WORD = re.compile(f"[^\\W_{HAN}]+|[{HAN}]")
_ASCII_WORDS = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))
#: The pre-tokenizer pattern of the public rank files.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the public rank file lies unless a caller names another.
RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_K = np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(33)


def words_of(text: str) -> list[str]:
    """The words of a text that is NFKC already."""
    text = text.lower()
    if text.isascii():
        return text.encode().translate(_ASCII_WORDS).decode().split()
    return WORD.findall(text)


class _WordHashes(dict):
    """64-bit hashes of words; a cache that is emptied when it has grown to its bound, so its memory stays fixed."""

    BOUND = 1 << 20

    def __missing__(self, word: str) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


def ngram_hashes(words: list[str], n: int) -> np.ndarray:
    """The distinct hashes of all runs of ``n`` words, sorted; empty for fewer words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    acc = h[:m].copy()
    for i in range(1, n):
        acc = acc * _K + h[i : i + m]
    return np.unique(mix(acc))


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """How many bands of ``rows`` min-wise hashes find a pair of that similarity with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


@functools.lru_cache(maxsize=8)
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 32, count, dtype=np.uint32), rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def min_hashes(hashes: np.ndarray, count: int) -> np.ndarray:
    """The smallest value of every one of ``count`` permutations of the high 32 bits; long sets go through in slices of bounded memory."""
    xor, mul = _permutations(count)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(high), 1024):
        part = high[at : at + 1024, None] ^ xor
        part *= mul
        np.minimum(low, part.min(axis=0), out=low)
    return low.astype(np.uint64)


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per band, of ``rows`` min-wise n-gram hashes each; empty for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    low = min_hashes(hashes, bands * rows).reshape(bands, rows)
    acc = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        acc = mix(acc * _K + low[:, i])
    return acc.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, float]:
    """Common entries and similarity of two sorted arrays of distinct values."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both, both / union if union else 0.0


def shingles(text: str, n: int) -> np.ndarray:
    return ngram_hashes(words_of(nfkc(text)), n)


@functools.lru_cache(maxsize=4)
def tokenizer(path: str = RANK_FILE):
    """A byte-level tokenizer from a rank file; one per worker process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def token_bytes(path: str = RANK_FILE) -> np.ndarray:
    """The length in bytes of every token."""
    enc = tokenizer(path)
    return np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)], np.int64)


def count_tokens(text: str, path: str = RANK_FILE) -> int:
    return len(tokenizer(path).encode_ordinary(text))


#: Classes of characters, in the order of :func:`class_table`.
CLASSES = ("lower", "upper", "letter", "han", "digit", "space", "newline", "stop", "symbol", "odd")
#: Marks that belong to running prose, in Western and Chinese typesetting.
PROSE_MARKS = ".,;:!?'\"()-–—‘’“”«»¿¡…。，、；：！？（）《》「」"


@functools.lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point."""
    import unicodedata

    table = np.full(0x110000, CLASSES.index("odd"), np.uint8)
    general = {"L": "letter", "N": "digit", "Z": "space", "P": "symbol", "S": "symbol", "M": "letter"}
    for first, last in ((0, 0x3400), (0xA000, 0xAC00), (0xD7A4, 0xD800), (0xF900, 0x20000)):
        for c in range(first, last):
            kind = unicodedata.category(chr(c))
            table[c] = CLASSES.index(general.get(kind[0], "odd"))
    for first, last in ((0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)):
        table[first : last + 1] = CLASSES.index("han")
    table[0xAC00:0xD7A4] = CLASSES.index("letter")
    table[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    table[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    table[[ord(c) for c in PROSE_MARKS]] = CLASSES.index("stop")
    table[[9, 0x3000]] = CLASSES.index("space")
    table[[10, 13]] = CLASSES.index("newline")
    table[0xFFFD] = CLASSES.index("odd")
    return table


def classes_of(text: str) -> np.ndarray:
    """The class of every character."""
    return class_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
