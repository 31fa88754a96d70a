"""Several places of a notice in one window."""

from __future__ import annotations

import random
import time

import pytest

from lendspark.llm import licenses


@pytest.mark.parametrize(
    "text, want",
    [
        ("mit licence mit license", [(0, 1), (2, 0)]),
        ("license mit licence license mit license license mit licensf", [(1, 1), (4, 0), (7, 1)]),
        ("mit licence " * 30 + "mit license", [(2 * i, 1) for i in range(30)] + [(60, 0)]),
    ],
)
def test_places_before_a_better_one_are_kept(text, want):
    spans = [s for s in licenses.spans_of(text) if s["notice"] == "mit license"]
    assert [(s["first_word"], s["edits"]) for s in spans] == want


def near(notice: str, limit: int, text: str, begin: int) -> dict[int, int]:
    """The edits to every end of a stretch of `text` from `begin` on, by the plain table; those within the limit."""
    found, line = {}, list(range(len(notice) + 1))
    for end in range(begin, min(len(text), begin + len(notice) + limit) + 1):
        if end > begin:
            last, line = line, [line[0] + 1]
            for j, letter in enumerate(notice, 1):
                line.append(min(last[j] + 1, line[-1] + 1, last[j - 1] + (text[end - 1] != letter)))
        if line[-1] <= limit and (end == len(text) or text[end] == " "):
            found[end] = line[-1]
    return found


def changed(pick: random.Random, notice: str) -> str:
    letters = list(notice)
    for _ in range(pick.randint(0, 6)):
        at, kind = pick.randrange(len(letters)), pick.random()
        letters[at : at + 1] = [] if kind < 0.3 else ["x"] if kind < 0.7 else [letters[at], pick.choice("ab ")]
    return "".join(letters)


def test_labels_and_score_equal_a_comparison_with_every_stretch(spark):
    pick = random.Random(12)
    notices = {**licenses.BASE, **licenses.NOTICES}
    texts = ["", "mit", "license mit", "cc by cc by"]
    for _ in range(120):
        parts = [changed(pick, pick.choice([*notices])) if pick.random() < 0.6 else pick.choice(["foo", "é", "mit", "by", "license"]) for _ in range(pick.randint(1, 6))]
        texts.append(licenses.words_of(" ".join(parts).encode()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.summary(licenses.scan(docs)).collect()}
    for doc_id, text in enumerate(texts):
        labels, score = set(), 0.0
        for notice, label in notices.items():
            for begin in [0, *(i + 1 for i, c in enumerate(text) if c == " ")]:
                for edits in near(notice, licenses.edits_of(notice), text, begin).values():
                    labels.add(label)
                    score = max(score, 1 - edits / len(notice))
        assert got[doc_id] == (",".join(sorted(labels)), pytest.approx(score)), text


def test_a_text_that_is_one_list_of_notices_takes_time_in_proportion():
    text = "mit licence " * 50_000 + "mit license"
    begin = time.monotonic()
    spans = [s for s in licenses.spans_of(text) if s["notice"] == "mit license"]
    assert len(spans) == 50_001 and spans[-1]["first_word"] == 100_000
    assert len(licenses.base_places(text)) == 1
    assert time.monotonic() - begin < 60  # with the square of the text it was above ten minutes
