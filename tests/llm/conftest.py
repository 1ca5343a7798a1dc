import random

import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside, as columns of their own that must not disturb them.
CLASHING = [
    "id", "key", "fp", "root", "node", "task", "within", "begin", "length", "sequence_id", "offset", "score", "rank", "label",
    "grade", "words", "range", "ahead", "kept_id", "kept_signature", "held_out", "n_bytes", "component_id", "signature",
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every kind of row that real tables hold, and columns with clashing names."""
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta,", "épsilon", "zeta.", "12", "eta"]
    long_text = " ".join(rng.choice(words) + str(i % 700) for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta", "en", "a"), (2, "alpha beta gamma delta", "en", "a"), (3, "", "en", "a"), (4, None, "en", None),
        (5, "   \n\t ", None, "b"), (6, "1234 !!", "de", "b"), (7, long_text, "en", "b"), (8, long_text + " end", "en", "b"),
        (9, "x", "de", "c"), (9, "x", "de", "c"), (9, "another text with the same id", "de", "c"), (None, "no id at all here", "fr", "c"),
        (None, "no id at all here", "fr", "c"), (None, None, None, None), (10, "ümläut straße 東京 😀 end", "de", "c"),
        (11, "ALPHA beta GAMMA delta", "en", "a"), (12, " leading and trailing ", "en", "a"), (13, "a  b   c\r\nd", "en", "a"),
        (-5, "negative id text", "en", "a"), (20, "<|endoftext|> <s> ▁ inside <|user|>", "en", "a"),
    ]
    table = spark.createDataFrame([(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows], DOCUMENTS).repartition(3)
    return table.withColumns({name: F.lit(7) for name in CLASHING})


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
