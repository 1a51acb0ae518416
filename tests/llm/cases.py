"""Small documents with the awkward cases, and plain-Python counterparts."""

import random
import re

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keys string, row int, `__row` int"


def edge_texts(seed: int = 1) -> list[tuple]:
    """(doc_id, text): copies, shared passages, NULLs, blanks, repeated ids, one long text."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Ünï", "語", "ab", "."]

    def passage(n: int) -> str:
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\n", "\t"]) for _ in range(n))

    shared = [passage(n) for n in (22, 25, 40, 19, 60)]
    rows: list[tuple] = []
    for i in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.3 else passage(rng.randint(1, 40)) for _ in range(rng.randint(0, 6))]
        rows.append((i * 2, "".join(parts)))
    rows += [(1, rows[10][1]), (3, rows[10][1]), (201, rows[11][1]), (203, None), (5, ""), (7, "   \n\n "), (9, "one")]
    rows += [(300, rows[20][1] + "\n" + rows[20][1]), (302, passage(4000) + shared[0] + passage(3000) + shared[0])]
    rows += [(None, rows[15][1]), (None, rows[16][1]), (None, None)]
    rows += [rows[12], rows[12], (rows[13][0], rows[14][1])]  # a repeated row, and an id with another text
    return rows


def frame(spark, texts):
    rows = [(i, t, "en", "s", None if t is None else len(t), "k", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def place(i, text):
    """The order of documents: rows without an id last, by a hash of the text."""
    if i is not None:
        return i
    hashed = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return 2**63 - 1 - (hashed & (2**60 - 1))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(texts, units, size):
    """For each row the units in windows that started before: by a smaller id or in the same row."""
    smallest: dict = {}
    sequences = [units(t) for _, t in texts]
    for (i, t), seq in zip(texts, sequences):
        for p in range(len(seq) - size + 1):
            key = tuple(seq[p:p + size])
            smallest[key] = min(smallest.get(key, place(i, t)), place(i, t))
    out = []
    for (i, t), seq in zip(texts, sequences):
        gone, seen = [False] * len(seq), set()
        for p in range(len(seq) - size + 1):
            key = tuple(seq[p:p + size])
            if smallest[key] < place(i, t) or key in seen:
                gone[p:p + size] = [True] * size
            seen.add(key)
        out.append((seq, gone))
    return out
