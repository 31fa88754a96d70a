"""The model of bytes looks five bytes back."""

from __future__ import annotations

from lendspark.llm import ppm


def test_a_gram_holds_five_bytes_of_context():
    grams, _ = ppm.grams_of([b"abcdef"])
    assert grams[5] == int.from_bytes(b"abcdef")
