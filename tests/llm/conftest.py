from __future__ import annotations

import pytest

# Names that the operators use inside, as columns of the input.
CLASHES = (
    "fp", "words", "pos", "window", "hash", "group", "start", "item_id", "node", "kept", "host",
    "__id", "__hash", "__text_hash", "__spans", "__lang", "__score", "__host", "__bad",
    "text_hash", "best_id", "best_hash", "hit_id", "hit_hash", "label_id", "id", "y", "half",
    "pii_spans", "lang_pred", "lang_score", "place", "row", "n", "bucket", "x", "v",
)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows, clashing columns."""
    long = " ".join(f"w{i} Of" for i in range(30_000))
    rows = [
        (None, None, None, None), (None, "no id but a text of five words", "en", "a"),
        (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n\x0b\x0c\r ", None, "a"),
        (4, "Word", "en", "b"), (5, "word", "en", "b"), (6, long, "en", "b"), (7, long, "en", "b"),
        (8, "the same row twice over and over", "en", "c"),
        (8, "the same row twice over and over", "en", "c"),
        (9, "one id and two texts here now", "de", "c"), (9, "quite another text of the id", "de", "c"),
        (10, "mail a@b.example and \U0001f600 10.0.0.1 now", "en", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.selectExpr("*", "cast(length(text) as bigint) AS n_chars",
                         *(f"'clash' AS {name}" for name in CLASHES))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
