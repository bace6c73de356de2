import pytest

SECRET = "0641917ea4e9feb9cda83477b57ac2654884f485"
LONG = "the quick brown fox jumps over the lazy dog " * 3000
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest string, "
          "fp long, row long, key string, score double, length int, part long, content string, "
          "hot boolean, word string, n int, n_tokens string, salt int, text_hash string")


def docs_of(spark, texts, ids=None, schema=SCHEMA):
    """Documents with extra columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    rest = (None, "src", None, "x", 1, 2, "k", 0.5, 3, 4, "c", True, "w", 5, "t", 6, "h")
    return spark.createDataFrame([(i, t, *rest) for i, t in zip(ids, texts, strict=True)], schema)


ODD_IDS = [5, 3, 3, 9, None, None, 7, 8, -1, 3, 12, 13]
ODD_TEXTS = [
    None, "", "", " \n\t", "A null id, twice", "a NULL id, twice", LONG, "x" * 5000,
    "Überraschung İstanbul ΣΑΣ 漢字 🙂 <|endoftext|> don't",
    "same id, other text", f'token = "{SECRET}"', "THE QUICK brown fox jumps over the lazy dog",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, one id with several texts."""
    return docs_of(spark, ODD_TEXTS, ODD_IDS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return docs_of(spark, [])


@pytest.fixture(scope="session")
def small(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
