import random

import pytest

from sparkcast.llm.queries import load_all

load_all()

WORDS = [f"w{i}" for i in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Documents with NULLs, empties, copies, a very long text and odd white space."""
    rng = random.Random(5)
    base = [sentence(rng, n) for n in (30, 60, 120, 200, 80)]
    shared = sentence(rng, 70)
    near = base[3].replace(base[3].split()[50], "changed", 1)
    long = " ".join(sentence(rng, 12) + "\n" for _ in range(1500))
    texts = [
        *base,
        None,
        "",
        " \n\t\n ",
        base[2],
        near,
        base[0] + "\n" + shared + "\n" + sentence(rng, 40),
        shared + " " + sentence(rng, 10),
        long,
        "Éa b ü 中文 <|endoftext|> don't \x1c stop",
        "one",
        "\n".join([base[1]] * 3),
        "### $$$ %%% &&& *** " * 12,
    ]
    rows = [
        (i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", None]), len(t or ""))
        for i, t in enumerate(texts)
    ]
    rows.append(rows[2])  # a repeated row
    rows.append((3, base[4], "en", "s1", 5))  # an id met before
    rows.append((None, base[1], "en", "s2", 7))
    rows.append((None, sentence(rng, 25), None, None, None))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use for columns of their own.
CLASHES = (
    "size target taken placements position words start stop length ids offset sequence_id key line "
    "kept n_words fingerprint component_id first_doc first rank score id doc text_key links parts n"
).split()


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(messy_rows, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("doc_id < -5")
