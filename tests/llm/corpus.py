"""Small tables that hold what is awkward: nulls, empty and long texts, copies, clashing columns."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, "
    "name string, n bigint, size bigint, hash string, cluster string, Score double, _k int"
)


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    base = prose(rng, 120).split()
    found: list[tuple[int | None, str | None]] = [(i, prose(rng, 60)) for i in range(10)]
    found += [(10, None), (11, ""), (12, " \t\n "), (13, "one two"), (14, "One  two"), (None, "x y")]
    found += [(15, "é" * 9000 + " ü"), (16, "é" * 9000 + "  ü"), (17, prose(rng, 6000)), (None, None)]
    for i in range(30):  # near copies, one to six words of 120 changed
        copy = list(base)
        for place in rng.sample(range(120), 1 + i % 6):
            copy[place] = f"changed{i}x{place}"
        found.append((100 + i, " ".join(copy)))
    found += [(200 + i, " ".join(base)) for i in range(5)]  # exact copies
    found += [(200, " ".join(base)), (3, "another text with the id three")]  # repeated rows and ids
    return found


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [
        (i, t, "en", None if n % 7 == 3 else f"s{n % 4}", n, "r", "n", 1, 2, "h", "c", 0.5, 9)
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, DOCS).repartition(5)
