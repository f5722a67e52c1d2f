import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.functions.text import nfkc
from corpusloom.llm import kernels as K


def plain_words(text):
    import regex

    out, run = [], ""
    for c in nfkc(text).lower():
        if regex.match(r"\p{Han}", c) and c.isalnum():
            out += [run, c] if run else [c]
            run = ""
        elif c.isalnum():
            run += c
        elif run:
            out.append(run)
            run = ""
    return out + [run] * bool(run)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB1_-. é中文\ń½Ａ々", max_size=40))
def test_words_are_the_plain_statement(text):
    assert K.words_of(nfkc(text)) == plain_words(text)


def test_ngrams_and_similarity():
    words = "a b c d e f g h".split()
    assert len(K.ngram_hashes(words, 3)) == 6 and len(K.ngram_hashes(words, 9)) == 0 and len(K.ngram_hashes(["a"] * 9, 3)) == 1
    a, b = K.ngram_hashes(words, 3), K.ngram_hashes(words[:-2], 3)
    assert K.jaccard(a, b) == (4, 4 / 6)
    assert K.jaccard(a[:0], a[:0]) == (0, 0.0)


def test_min_hashes_estimate_similarity():
    rng = np.random.default_rng(0)
    for shared in (600, 900):
        pool = rng.integers(0, 1 << 63, 2000 - shared, dtype=np.uint64)
        a, b = pool[:1000], pool[1000 - shared :]
        got = (K.min_hashes(a, 2000) == K.min_hashes(b, 2000)).mean()
        assert abs(got - shared / (2000 - shared)) < 0.04


def test_long_sets_go_in_slices():
    h = np.arange(1, 10_000, dtype=np.uint64) << np.uint64(40)
    low = K.min_hashes(h, 8)
    parts = np.minimum(K.min_hashes(h[:5000], 8), K.min_hashes(h[5000:], 8))
    assert (low == parts).all()


def test_bands_reach_their_recall():
    for rows in (3, 4):
        b = K.bands_for(0.6, rows, 0.999)
        assert 1 - (1 - 0.6**rows) ** b >= 0.999 > 1 - (1 - 0.6**rows) ** (b - 1)


def test_token_counts_match_the_other_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    for text in ("Hello world", "été  \n\n字 x1", ""):
        assert K.count_tokens(text) == len(t.encode(text, add_special_tokens=False).ids)
