import random

import pytest

LETTERS = "an ber ca de en fi gro hu il jo ka lem mi nu or pa qui re sta ti un ver".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(LETTERS, k=rng.randint(1, 4))) for _ in range(n)]


def corpus(seed: int = 3, n: int = 60) -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, shared passages, repeats and odd rows."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 40))
    rows: list[tuple[int, str | None]] = []
    for i in range(n):
        own = words(rng, rng.choice((3, 8, 30, 90, 200)))
        if i % 5 == 0:
            own[len(own) // 2 : len(own) // 2] = passage.split()[: rng.randint(10, 40)]
        text = " ".join(own)
        if i % 7 == 0 and rows:
            text = rng.choice([t for _, t in rows if t])  # a copy
        elif i % 7 == 1 and rows:
            near = rng.choice([t for _, t in rows if t]).split()
            for _ in range(max(1, len(near) // 40)):
                near[rng.randrange(len(near))] = "changed"
            text = " ".join(near)
        elif i % 7 == 2:
            text = text.replace(" ", "\n", 3).replace(" ", "\t ", 2).capitalize()
        rows.append((i * 3 + 1, text))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "\x1c\x85 é É ß"), (1004, "a" * 3000), (1005, "xy" * 400 + "é" * 60), (1006, " ".join(["same"] * 300)), (1007, " ".join(["same"] * 301))]
    rows.append((rows[8][0], rows[8][1]))  # a repeated row
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows_of_text():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows_of_text):
    """With further columns whose names an operator might use itself."""
    schema = "doc_id long, text string, grp string, component_id int, k1 int, h array<int>, line string, n_chars long"
    data = [(i, t, "x", 1, 2, [3], "y", None if t is None else len(t)) for i, t in rows_of_text]
    return spark.createDataFrame(data, schema).repartition(3)
