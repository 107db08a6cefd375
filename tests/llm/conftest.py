import pytest

from starloom.llm.queries import importable

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, bucket string, ids_ string"

NOTE = "Released under the MIT License."
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30000))
TEXTS = [
    None,
    "",
    " \t\n",
    "one two three",
    "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron\nrho sigma tau",
    "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron\nrho sigma tau",
    "É à l'été 日本 😀 ẞ x　y <|endoftext|> a▁b \x00 naïve",
    f"{NOTE}\nMail jo.do@mail.example.com or +1 (555) 010-2030, 10.0.0.256 and 192.168.1.7, 4111 1111 1111 1111.",
    "spam spam spam spam spam spam spam spam spam spam spam spam",
    LONG,
    LONG + " end",
]


@pytest.fixture(scope="session")
def docs(spark):
    importable(spark)
    rows = [(i, t, "en", f"src{i % 2}", len(t or ""), "b", "x") for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, "no id here " * 4, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], SCHEMA)
