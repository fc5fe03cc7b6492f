import pytest

#: Columns that the operators' own intermediate columns are named like.
CLASHING = "score double, node string, words string, size int, kept boolean, belief double, pattern int, host string, " \
    "term string, doc string, part int, nth int, first long, tokens string, rule string, toxic string, labels string, " \
    "hit_id string, hit_text string, kept_id string, of string, run string, block string, inside string, row string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
EXTRA = len(CLASHING.split(","))
WORDS = "river stone lamp quiet orange table winter cloud seven paper garden light ocean train silver morning".split()


def prose(seed: int, count: int) -> str:
    """Words in an order of their own for each seed."""
    out, state = [], seed * 2654435761 % 2**32 or 1
    for _ in range(count):
        state = (state * 1664525 + 1013904223) % 2**32
        out.append(WORDS[state >> 28] + WORDS[state >> 24 & 15])
    return " ".join(out)


@pytest.fixture
def make_documents(spark):
    """Documents of ``(doc_id, text)`` rows, with clashing extra columns that are null."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "en", "s", 1, *[None] * EXTRA) for i, t in rows], DOCUMENTS)

    return make


@pytest.fixture
def odd_rows():
    """Null, empty, blank, very long, repeated and tied rows, and a row without an id."""
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "x"), (5, prose(1, 60)), (5, prose(1, 60)), (6, prose(1, 60)),
        (7, "word " * 30_000), (8, prose(2, 20_000)), (None, prose(3, 70)), (9, "é日本 ###!! | \x0b" * 20),
    ]


@pytest.fixture
def make_labels(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return make


@pytest.fixture(name="prose")
def prose_fixture():
    return prose
