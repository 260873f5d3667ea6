import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import textscan


def words_of(text, pattern):
    return re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


PATTERNS = [(textscan.SPACED, r"[^\x20\x09-\x0D]+"), (textscan.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \n\t.-0你", max_size=30)), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    for table, pattern in PATTERNS:
        words = textscan.scan(pa.array(texts, pa.string()), table)
        want = [words_of(t, pattern) for t in texts]
        assert np.diff(words.first).tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        ids = {}
        for w, h in zip(flat, words.hash.tolist(), strict=True):
            assert ids.setdefault(w, h) == h
        assert len(set(ids.values())) == len(ids)


@pytest.mark.parametrize("size", [textscan.PIECE - 3, textscan.PIECE, textscan.PIECE + 5, 3 * textscan.PIECE])
def test_words_at_the_ends_of_pieces(size):
    text = ("abcdefg " * (size // 8 + 1))[:size]
    column = pa.array([text, "abcdefg", "x" * (textscan.PIECE + 100), "x" * (textscan.PIECE + 100) + " y", "abcdefg"])
    words = textscan.scan(column)
    h = words.hash
    assert np.diff(words.first).tolist() == [len(text.split()), 1, 1, 2, 1]
    whole = textscan.scan(pa.array(["abcdefg"])).hash[0]
    n = size // 8
    assert (h[:n] == whole).all() and h[words.first[1]] == whole and h[-1] == whole
    assert h[words.first[2]] == h[words.first[3]]


def test_sliced_columns_and_prefixes():
    column = pa.array(["zero", None, "lower Lowest", "low", "lowering"]).slice(1)
    words = textscan.scan(column, textscan.ALNUM, (4,))
    assert np.diff(words.first).tolist() == [0, 2, 1, 1]
    p = words.prefix[4]
    assert p[0] == p[1] == p[3] != 0 and p[2] == 0


def test_grams_stay_in_their_document():
    words = textscan.scan(pa.array(["a b c", "d e", "b c d"]))
    value, whole = textscan.grams(words, 2)
    assert whole.tolist() == [True, True, False, True, False, True, True, False]
    assert value[1] == value[5]
