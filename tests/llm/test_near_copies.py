"""Near copies against a plain comparison of all pairs."""

import random
import re

import pytest
from llm_tables import no_documents
from test_dedup import groups

from lendspark.llm import near_copies

SCHEMA = "doc_id long, text string, digest string"


def plain_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    size = min(size, len(words))
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def copies():
    """Families of edited texts around the threshold, loose ones, and awkward rows."""
    pick = random.Random(3)
    rows = []
    for length in (30, 80, 220):
        for _ in range(12):
            words = [f"w{pick.randrange(3000)}" for _ in range(length)]
            for edits in (0, 1, length // 60, length // 40, length // 12):
                changed = list(words)
                for _ in range(edits):
                    changed[pick.randrange(length)] = f"x{pick.randrange(10**6)}"
                rows.append((len(rows), " ".join(changed)))
    rows += [(900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one  TWO"), (905, "one"), (None, rows[0][1]), (None, "no id here")]
    return rows + [(903, "One two"), (None, "no id here")]


def kept_ids(rows):
    sets = [plain_set(text) for _, text in rows]
    root = groups([(i, j) for i in range(len(rows)) for j in range(i + 1) if similar(sets[i], sets[j])])
    classes = {}
    for i, (doc_id, _) in enumerate(rows):
        classes.setdefault(root[i], []).append(doc_id)
    best = (min((d for d in ids if d is not None), default=None) for ids in classes.values())
    return sorted(best, key=lambda d: (d is None, d))


@pytest.mark.parametrize("shard", [1000, near_copies.SHARD])
def test_classes_of_near_copies(spark, shard):
    rows = copies()
    docs = spark.createDataFrame([(doc_id, text, "clash") for doc_id, text in rows], SCHEMA)
    kept = near_copies.drop_near_copies(docs, shard=shard)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=lambda d: (d is None, d))
    assert got == kept_ids(rows)


def test_a_family_of_near_copies_leaves_one(spark):
    pick = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:200] + [str(pick.random())] + words[201:])) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in near_copies.drop_near_copies(docs).collect()] == [0]
    sets = near_copies.shingle_sets(docs, docs.doc_id.cast("string"), "doc_id", "text")
    assert near_copies.links(sets).count() <= near_copies.BANDS * len(rows)


def test_similarity_of_long_texts_is_exact(spark):
    words = [f"w{i}" for i in range(2000)]
    rows = [(0, " ".join(words))]
    for edits in (36, 46, 50):  # an edit changes five shingles: 0.84, 0.79 and 0.78
        changed = list(words)
        for i in range(edits):
            changed[20 + 40 * i % 1960 + i // 49] = f"x{edits}y{i}"
        rows.append((edits, " ".join(changed)))
    kept = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == kept_ids(rows) == [0, 46, 50]


def test_hashes_of_a_long_text_are_taken_in_steps():
    text = " ".join(str(i % 977) for i in range(near_copies._AT_ONCE + 5000))
    assert len(near_copies.shingles(text.encode())) == len(plain_set(text)) == 977


def test_no_documents(spark):
    assert near_copies.drop_near_copies(no_documents(spark)).count() == 0
