"""Nothing that an operator stored outlives the scratch block it ran in."""

import os

from llm_tables import documents

from lendspark.llm import bpe, ppm
from lendspark.session import scratch, shared_dir


def stored(spark) -> tuple[set, set]:
    folder = f"{shared_dir(spark)}/lendspark"
    files = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    return files, {t.name for t in spark.catalog.listTables()}


def test_blocks_and_tries_go_with_their_scratch_block(spark):
    before = stored(spark)
    with scratch(spark):
        ids = bpe.round_trip(documents(spark), *bpe.public_tokenizer(spark))
        assert ids.count() > 0
        assert ppm.score_documents(documents(spark).where("n_chars < 5000")).count() > 0
        assert stored(spark) != before
    assert stored(spark) == before
