import os

TOKENIZERS = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers")


def prose(seed, n):
    import random

    rnd = random.Random(seed)
    syllables = ["ba", "ke", "lo", "mi", "tu", "ra", "ne", "so", "vi", "du", "pa", "le"]
    return " ".join("".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(n))


def edge_rows():
    """Nulls, empty and wordless texts, a long text, ties, copies, near copies and repeated rows."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "other", 1)
    rows = [(0, base), (1, base), (2, near), (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (7, "one  two"), (8, prose(2, 90)), (8, prose(2, 90)), (9, prose(3, 30_000)), (None, base), (None, None)]
    rows += [(10 + i, prose(100 + i, 60 + i) + "\n" + "A line that all of these documents have in common, word for word.", None if i % 5 == 0 else f"src{i % 3}") for i in range(30)]
    return rows
