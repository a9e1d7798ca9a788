import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts or (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, source = (*row, "a")[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
