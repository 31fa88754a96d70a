"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ("ka", "lo", "mi", "ter", "an", "sou", "é", "ß")
LICENSE = "Released under the GNU General Public License, see below. "


def prose(seed: int, words: int) -> str:
    """Invented words; the same seed gives the same text."""
    pick = random.Random(seed)
    made = ("".join(pick.choice(SYLLABLES) for _ in range(pick.randint(1, 4))) for _ in range(words))
    return " ".join(word.capitalize() + "." if i % 9 == 0 else word for i, word in enumerate(made))


def rows() -> list[tuple]:
    passage = prose(500, 70)
    plain = prose(1, 120)
    found = [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (3, plain + "\n", "en", "b"),
        (4, plain.replace(" ", "  "), "en", None),
        (5, None, None, None),
        (6, "", "de", "b"),
        (7, " \t\n", "de", "b"),
        (8, prose(2, 60) + " " + passage + " " + prose(3, 40), "fr", "c"),
        (9, prose(4, 10) + "\n" + passage + "\n" + prose(5, 90), "fr", "c"),
        (10, passage, "es", "a"),
        (11, LICENSE + prose(6, 30), "en", "a"),
        (12, "apache licence " + prose(7, 20) + " MIT-license, CC BY", "en", "a"),
        (None, prose(8, 50), "en", "a"),
        (None, prose(8, 50), "en", "a"),
        (13, "ABC!! DEF!! " * 40, "en", "b"),
        (14, prose(9, 4000), "en", "a"),
        (14, prose(9, 4000), "en", "a"),
        (15, "one", "en", None),
        (16, "don't they'll  stop\u00a0\u2028 x\ufffd\U0001f600 12345 <|endoftext|>", "en", "c"),
        (17, prose(9, 4000).replace("Ka", "Lo", 1), "en", "a"),
    ]
    found += [(100 + i, prose(1000 + i, 30 + i), "en", "abc"[i % 3]) for i in range(40)]
    return [(i, text, lang, source, None if text is None else len(text)) for i, text, lang, source in found]


def documents(spark, clashing: bool = False):
    df = spark.createDataFrame(rows(), DOCS).repartition(3)
    if clashing:
        for name in ("_row", "_doc", "_0", "_1", "row", "id", "fp", "run", "digest", "block", "size", "shard", "payload", "score", "key", "learn"):
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def stored(df, folder) -> str:
    df.write.parquet(str(folder))
    return str(folder)
