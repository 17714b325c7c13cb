import pytest

DOC = "doc_id long, text string, lang string, id long, v string, keys string, n int, row long, score string, label string, bands string"


def document_rows(pairs):
    """Rows of documents with extra columns whose names the operators use inside."""
    return [(i, t, "xx", -1, "v", "k", 0, 7, "s", "l", "b") for i, t in pairs]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(pairs, partitions=3):
        return spark.createDataFrame(document_rows(pairs), DOC).repartition(partitions)
    return make


@pytest.fixture(scope="session")
def public_file():
    import public_tokenizers

    return public_tokenizers.path


@pytest.fixture(scope="session")
def sf01():
    return "/root/testdata/sf0.01"
