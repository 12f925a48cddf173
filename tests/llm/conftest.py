import random

import pytest

WORDS = [a + b for a in "ba ce di fo gu ka le mi no pu ra se ti vo zu".split() for b in "l n r s t x m d".split()]


def prose(seed: int, n: int, stop: int = 12) -> str:
    """``n`` made-up words in lines."""
    draw = random.Random(seed)
    out = [draw.choice(WORDS) + draw.choice(["", draw.choice(WORDS)]) for _ in range(n)]
    return "".join(w + (".\n" if (i + 1) % stop == 0 else " ") for i, w in enumerate(out)).strip()


@pytest.fixture(scope="session")
def mixed(spark):
    """Ordinary texts with nulls, empty and very long texts, copies, repeated rows, a null id and odd extra columns."""
    long = prose(7, 30_000)
    rows = [
        (1, prose(1, 120)),
        (2, prose(2, 120)),
        (3, prose(1, 120)),
        (3, prose(1, 120)),
        (4, None),
        (5, ""),
        (6, long),
        (7, long[:-40] + " an altered ending"),
        (8, "one"),
        (9, "  \n\t "),
        (10, "été 日本 🙂 été"),
        (None, prose(2, 120)),
        (None, None),
        (11, prose(11, 60) + " " + prose(1, 120) + " " + prose(12, 60)),
        (12, "ab " * 2000),
    ]
    extra = "label string, _digest string, key int, `at` int, start int, shard int, fingerprint string, n_chars bigint"
    return spark.createDataFrame([(i, t, "x", "y", n, n, n, n, None, n) for n, (i, t) in enumerate(rows)], f"doc_id bigint, text string, {extra}")


@pytest.fixture(scope="session")
def none(mixed):
    return mixed.limit(0)
