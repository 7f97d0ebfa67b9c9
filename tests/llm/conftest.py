import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def invented(rng, n, letters="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture
def corpus(spark):
    """Documents with near and exact copies, shared passages, nulls, empty and long texts, repeated rows and clashing columns."""
    rng = random.Random(11)
    texts = [invented(rng, rng.randint(1, 160)) for _ in range(60)]
    for k in range(12):
        w = texts[k].split()
        for _ in range(1 + len(w) // 40):
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [texts[3], texts[3], texts[4].upper(), invented(rng, 30_000), "", " \n\t ", "one two three", "a", "é ü ß 数据 " * 40, "de " * 300, "x" * 70_000]
    rows = [(i * 3, t, ["en", "de", None][i % 3], f"src{i % 4}", len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (1000, None, None, None, None), (None, texts[6], "en", "src0", 5), (None, None, None, None, None)]
    rng.shuffle(rows)
    clashing = ", score double, predicted int, n long, sig long, a long, b long, k long, part int, id long, hub long, _doc long, rep long, component_id long, found int, label int"
    return spark.createDataFrame([(*r, 0.5, *([7] * 14)) for r in rows], SCHEMA + clashing)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
