"""Rows that every operator has to survive."""

import random

EXTRA = "row string, bucket string, node string, range string, label string, live string, wanted string, bit string, component string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def prose(seed: int, words: int) -> str:
    """Invented words, the same for the same seed."""
    random_ = random.Random(seed)
    parts = ("ta", "ren", "ou", "el", "mi", "sor", "an", "ke", "vi", "do", "ul", "ba")
    return " ".join("".join(random_.choices(parts, k=random_.randint(1, 4))) for _ in range(words))


def frame(spark, texts, ids=None, sources=None):
    """Documents with clashing further columns."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t), *["x"] * 9) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def edge_texts() -> list:
    """Null, empty, blank, tiny, very long, non-ASCII, without a blank, repeated."""
    long_text = prose(1, 20_000)
    return [None, "", " \t\n", "a", "The The the", long_text, "Ünïcode é漢字 😀 x" * 3, "x" * 5000, prose(2, 60), prose(2, 60), "\n\n a \n\n a \n"]
