import pytest

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="session")
def model_path():
    import public_tokenizers

    return public_tokenizers.path(MODEL)


@pytest.fixture
def tables(spark, tmp_path):
    """Write small tables as a folder of the test data: tables(documents=[...]) -> path."""
    schemas = {
        "documents": "doc_id long, text string, lang string, source string, n_chars long",
        "benchmark": "item_id long, text string",
        "pages": "page_id long, url string, html string",
        "conversations": "conv_id long, turn long, role string, text string",
    }

    def write(**rows):
        for name, schema in schemas.items():
            width = len(schema.split(","))
            filled = [tuple(r) + (None,) * (width - len(r)) for r in rows.get(name, [])]
            spark.createDataFrame(filled, schema).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
