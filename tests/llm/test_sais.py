"""Suffix arrays and permuted prefixes against sorting."""

import random

import numpy as np
import pytest

from cairnframe.llm import sais


def texts():
    r = random.Random(8)
    for size in (0, 1, 2, 5, 40, 300):
        for alphabet in ("a", "ab", "abc", "abcdefghijklmnop"):
            yield "".join(r.choices(alphabet, k=size))
    yield "mississippi" * 7
    yield "abracadabra" + "a" * 60 + "b" * 50 + "a" * 60
    block = "".join(r.choices("abcd", k=90))
    yield block + "x" + block + "y" + block[:70] + "z" + block


@pytest.mark.parametrize("text", list(texts()))
def test_against_sorting(text):
    symbols = np.array([*(ord(c) for c in text), 0], np.uint16)
    want = sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
    order = sais.suffix_array(symbols)
    assert order.tolist() == want
    plcp = sais.permuted_prefixes(symbols, order)
    for k in range(1, len(want)):
        a, b = want[k - 1], want[k]
        n = 0
        while max(a, b) + n < len(symbols) and symbols[a + n] == symbols[b + n]:
            n += 1
        assert plcp[b] == n
