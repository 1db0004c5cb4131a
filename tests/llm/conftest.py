import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text, lang, source) tuples."""
    def build(rows):
        return spark.createDataFrame(
            [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCUMENTS)
    return build


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"word{k % 997}" for k in range(30_000))
    rows = [(1, "same text here for all", "en", "a"), (2, "same text here for all", "en", "b"),
            (2, "same text here for all", "en", "b"), (3, None, None, None), (4, "", "en", "a"),
            (5, "   \n \t", None, "a"), (None, "no id at all", "en", None), (6, long, "en", "a"),
            (7, "Ünïcode 世界 🙂 text", "de", "ü"), (8, "other text", "en", None), (None, None, None, None)]
    return documents(rows)



@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with extra columns under names that operators use."""
    from pyspark.sql import functions as F
    extra = ("keep_id", "group_size", "kept", "digest", "file", "row", "n_shingles", "component_id", "size", "copies",
             "_run", "_skey", "_size", "_doc", "_row", "_gone", "shard", "spans", "score", "h", "w", "removed")
    return awkward.withColumns({name: F.lit("x") for name in extra})


