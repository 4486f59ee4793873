import pytest

# What every operator has to bear: nulls, empty and very long texts, ties, repeated rows, unlikely characters.
BASE = (
    "The quay walls of the old harbour were repaired in spring and the crane was painted in a light grey while the "
    "harbour master counted the boats that came in with the tide and wrote their names into a large book of records"
)
TEXTS = [
    None, "", " \t\n ", "one", "one two three", BASE, BASE, BASE + ".", BASE.replace("crane", "tower"), BASE.upper(),
    "\n".join(f"line {i} of a text about boat {i * 7}" for i in range(60)), "x" * 20_000, "word " * 5_000,
    "日本語 のテキスト ñandú straße \U0001f642 <|endoftext|> <s> \x00\x1c", "a  b   c\r\n\r\nd\te",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with everything odd in them, and columns whose names the operators use themselves."""
    rows = [(i if i != 3 else None, t, ["en", None, "de"][i % 3], ["a", None][i % 2], i, i, "x", None, 1.5)
            for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], rows[0], rows[3]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id long, row string, key string, "
        "component double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
