"""A conversation whose turns have one number, or none, is split between tasks and reads back in order."""

import random

from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_corpus_operators import by_id, words
from touchline.llm import chat

COLUMNS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def test_turns_without_numbers_are_split(spark):
    rng = random.Random(9)
    same = " ".join(words(rng, 30))  # a beginning that many texts share
    rows = [(1, None, rng.choice(["user", "assistant", None]), rng.choice(["", f"{same} {i}", " ".join(words(rng, 6)), "é" + str(i)])) for i in range(1_500)]
    rows += [(1, 7, "user", f"numbered {i % 40}") for i in range(200)] + [(2, 0, "user", None), (None, None, "assistant", "x")]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # it would merge what is small here
    pieces = chat.formatted(turns)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pieces.filter("conv_id = 1").agg(F.count_distinct("part")).first()[0] > 2
    # NULL sorts first, before the empty text and role it counts as.
    key = lambda r: tuple((v is not None, v if v is not None else 0 if i < 2 else "") for i, v in enumerate(r))
    by_turn = [(c, n, role, text) for n, (c, _, role, text) in enumerate(sorted(rows, key=key))]
    assert by_id(chat.digests(pieces), *COLUMNS[:4], key="conv_id") == brute.conversations(by_turn)
