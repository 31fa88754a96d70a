"""Spelling variants: words one edit apart, found by permuterm rotations, and each tied to a far more frequent one.

Every word gets a terminator and is turned to start at each of its places. In the sorted list of all these
rotations, the words that differ in their character before the turn stand together, as they share everything
but the last character; the word that lacks this character stands before them, as a whole rotation of it is what they share.
So a group is a prefix of rotations: it holds the words that a replacement there turns into each other, and
the one word that a deletion there leaves. A group has one word per letter of the alphabet (90) and one more,
however many words there are, and is read once in order of frequency: each member needs the number of the others and
the best of them, never all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.common import cut

LETTERS = "A-Za-z\u00C0-\u00FF"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
END = "$"  # never part of a word
SHORTEST = 5
LEAST = 3
RATIO = 2
THINNED = 97
KEPT = 64  # longer rotations are kept as digests


def thinned(id_text: Column, run: Column) -> Column:
    """The word, without one of its characters where the CRC-32 of id and word is divisible by THINNED."""
    h = F.crc32(F.concat(id_text, F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % THINNED == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, shortest: int = SHORTEST) -> DataFrame:
    """(word, n): the words of all texts, thinned, that have `shortest` characters and occur `least` times or more.

    A null text has no words; a null id counts as an empty one; repeated rows count each. Other columns are not read.
    """
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = df.select(id_text.alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("run"))
    lowered = runs.select("id", F.translate("run", CAPITALS, CAPITALS.lower()).alias("run"))
    words = lowered.select(thinned(F.col("id"), F.col("run")).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _entries(words: DataFrame) -> DataFrame:
    """Every rotation as a whole, and every one without its last character: (key, skips, first, word, n).

    `first` says that the skipped character is the first of a run of equal ones. Skipping another one of the run
    gives the same shorter word again, which must count once.
    """
    marked, word, i = F.concat("word", F.lit(END)), F.col("word"), F.col("i")

    def key(head: Column) -> Column:
        turned = F.concat(F.substring(marked, i + 1, F.length(marked)), F.substring(word, F.lit(1), head))
        return F.when(F.length(turned) > KEPT, F.sha2(turned, 256)).otherwise(turned)

    skipped, before = F.substring(word, i, F.lit(1)), F.substring(word, i - 1, F.lit(1))
    whole = F.struct(key(i).alias("key"), F.lit(False).alias("skips"), F.lit(False).alias("first"))
    prefix = F.struct(key(i - 1).alias("key"), F.lit(True).alias("skips"), ((i == 1) | (skipped != before)).alias("first"))
    placed = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    each = placed.select("word", "n", F.explode(F.when(i == 0, F.array(whole)).otherwise(F.array(whole, prefix))).alias("e"))
    return each.select("e.key", "e.skips", "e.first", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best: struct<less, word>) of the words of (word, n) that have a near one; `less` is -n."""
    order = Window.partitionBy("key").orderBy("standing").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entries = _entries(words).withColumn("standing", F.struct((-F.col("n")).alias("less"), F.col("word").alias("word")))
    scanned = entries.select(
        "word", "skips", "first", "standing",
        F.count_if("skips").over(order).alias("skipping"),
        F.count_if("first").over(order).alias("shortened"),
        F.count_if(~F.col("skips")).over(order).alias("whole"),
        F.first("standing").over(order).alias("top"),
        F.nth_value("standing", 2).over(order).alias("second"),
    )
    met = scanned.where(F.col("second").isNotNull())
    near = F.when(F.col("skips"), F.col("skipping") - 1 + F.when(F.col("first"), F.col("whole")).otherwise(0)).otherwise(F.col("shortened"))
    other = F.when(F.col("top.word") == F.col("word"), F.col("second")).otherwise(F.col("top"))
    return met.groupBy("word").agg(F.sum(near).alias("n_near"), F.min(other).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, up): links are doubled until none goes further. They lead to ever more frequent words, so
    that there are no circles, and at most log2(log2(largest n)) rounds."""
    while True:
        above = forms.select(F.col("word").alias("up"), F.col("up").alias("higher"))
        # Both sides are stored, so that Spark can split the words below one frequent form.
        joined = cut(forms.join(above, "up", "left").select("word", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("moved")))
        forms = joined.select("word", "up")
        if joined.where("moved").isEmpty():
            return forms.select("word", F.col("up").alias("root"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n: long), one row per word, none of them null.

    Two words are near if one character is inserted, deleted or replaced. A word's form is its near word of the largest
    n (ties: the smallest in code-point order) if that n is at least `ratio` times its own, `ratio` being 2 or more;
    else null. The root is where the forms end. An empty table gives no rows.
    """
    words = cut(words.select("word", "n"))
    best = F.col("best")
    fits = -best.less >= ratio * F.col("n")
    tied = cut(
        words.join(near_words(words), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, best.word).alias("form"), F.when(fits, -best.less).alias("form_n"),
        )
    )
    roots = _roots(tied.where("form IS NOT NULL").select("word", F.col("form").alias("up")))
    return tied.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
