import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from conftest_path import FOLDER  # noqa: E402

from ledgerloom.llm.stored import package_on_workers  # noqa: E402




@pytest.fixture(autouse=True)
def workers(spark):
    package_on_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture
def odd_texts(spark):
    """Null, empty, wordless, repeated, very long and unsplit texts; a null key; clashing column names."""
    texts = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (4, "one"),
        (5, "Two words"),
        (None, "No key at all here"),
        (6, "word " * 60_000),
        (7, "x" * 9_000 + "yé" * 2_000),
        (8, "12 34 !! 56"),
        (9, "emoji 🙂 and ünïcode 　 spaces <|endoftext|> inside"),
    ]
    names = ("ids", "score", "kept", "node", "lang_pred", "held_out", "component", "unit", "block")
    return spark.createDataFrame(
        [(key, text, *["clash"] * len(names)) for key, text in texts],
        "doc_id long, text string, " + ", ".join(f"{n} string" for n in names),
    )


@pytest.fixture
def no_texts(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, toxic int")
