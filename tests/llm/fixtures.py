"""Small tables for the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names clash with ones that operators use inside.
CLASHING = "doc_id long, text string, key string, h long, size int, shard int, token long, start int, bucket string, class int"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(seed=0, n=60):
    """Random texts with exact copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    passage = words(rng, 60, 10_000)
    rows = []
    for i in range(n):
        text = words(rng, rng.choice([1, 2, 3, 4, 30, 120, 300]))
        if i % 5 == 1 and i > 5:
            text = rows[rng.randrange(len(rows))][1]
        if i % 5 == 2 and i > 5 and rows[i - 2][1]:
            parts = rows[i - 2][1].split(" ")
            parts[rng.randrange(len(parts))] = "Changed"
            text = " ".join(parts)
        if i % 6 == 3:
            text = f"{words(rng, 20)} {passage[: rng.choice([150, 250, 400])]} {words(rng, 10)} äöü€😀"
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, words(rng, 20_000, 50_000)), (n + 4, "ab" * 300), (n + 5, "x" * 199), (n + 6, "x" * 200), (n + 7, "x" * 201), (n + 8, "É É " * 80)]
    rows += [rows[0], rows[7]]
    return rows


def clash(rows):
    return [(i, t, "k", 7, 1, 2, 3, 4, "b", 5) for i, t in rows]
