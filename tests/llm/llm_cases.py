"""Cases that every operator must take."""

import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# null and empty texts, blanks, no letters, special strings, other scripts,
# characters beyond the basic plane, a very long text, a very long word
EDGE_TEXTS = [
    None, "", " ", "\n\n \t", "!!! ... ???", "123 456", "a", "word", "two words", "<|endoftext|> x <|startoftext|>",
    "it's they're ''ve 'sabc", "日本語テキスト と 日本", "😀👍🏽 emoji 𝒜", "ΑΣ ΣΑΣ İstanbul ﬁ", "é é ß Ä",
    "a\x00b\x1c\x85\xa0c", "▁▁ under ▁x", "x " * 20_000, "y" * 30_000, "The the THE the of and\nThe the THE the of and",
]


def edge_rows():
    """Each edge text, two repeated rows, rows without an id, and a group of copies."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[7], rows[8], (None, "no id here", None, None, None), (None, None, "en", "s", 0)]
    rows += [(100 + i, "same text in many rows of one group", "en", "hot", 35) for i in range(40)]
    return rows


def rnd_text(rnd: random.Random, n: int, alphabet) -> str:
    return "".join(rnd.choice(alphabet) for _ in range(n))


# names that operators use inside, and names that Spark must quote
CLASHING = ("a.b", "c0", "gone", "mark_id", "_text_hash", "_gone_id", "_key", "_at", "_again", "digest.x", "`q`",
            "four", "cell", "part", "key", "pid", "before", "taken", "target", "links", "groups", "n_a", "a", "b", "n", "id",
            "size", "shard", "slot", "kept", "rank", "n_tokens", "cls", "rep", "digest", "_row", "stratum", "ids")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge cases with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), DOC_SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, F.lit("clash"))
    assert set(CLASHING) < set(df.columns)
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
