import random

import pytest


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["stone", "river", "Lamp", "ochre", "tide", "fern", "quill", "é", "mast", "nine"])
                    + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with every awkward case: null and empty text, null and repeated ids, exact
    and near copies, a very long text, and columns named like the operators' own."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), words(rng, 80), words(rng, 3), "a b c", "A  b\tC", "", None, "   \n\t ",
             words(rng, 30) + " " + base, words(rng, 20000), "x" * 3000, "ab" * 2000, "日本語 テキスト ñandú 🙂 " * 30]
    rows = [(i, t, "kept", -1, "n", True) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "again", 0, "", False), (4, "another text under the same id", None, None, None, None),
             (None, base, "noid", 1, "c", True), (None, None, "noid", 1, "c", True)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, kind string, n_tokens int, component_id string, kept boolean").repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, n_chars bigint")
