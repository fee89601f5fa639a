"""Small tables for the operators of claimsieve.llm."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "re", "sal", "ven", "dor") for b in ("n", "ra", "sto", "li", "ter", "dum")]


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) for _ in range(n)]
    lines = [" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12)]
    return "\n".join(lines)


def rows(n: int = 60, seed: int = 1):
    """Prose with exact copies, near copies, empty and NULL texts, NULL columns and a repeated row."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = prose(rng, rng.choice((3, 40, 120, 300)))
        if i % 7 == 3 and i > 10:
            text = out[i - 5][1] or ""
        if i % 11 == 5 and i > 10:
            text = "  " + (out[i - 3][1] or "").replace(" ", "\t", 2)
        out.append((i, text, rng.choice(("en", "de", None)), rng.choice(("a", "b", "c", None)), len(text or "")))
    out[2] = (2, "", "en", "a", 0)
    out[3] = (3, None, None, None, None)
    out[4] = (4, " \n\t ", "de", "b", 4)
    out.append(out[min(20, n - 1)])
    out.append((None, "one without an id", "en", "a", 17))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def widened(df):
    """The same table with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    extra = ("row", "size", "f", "h", "name", "n", "words", "slot", "draw", "key", "score", "kept", "window", "target", "band")
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(extra)])
