from __future__ import annotations

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def prose(seed: int, n: int) -> str:
    """n words that hold no five in a row twice, different for each seed."""
    draw = random.Random(seed)
    return " ".join(f"{draw.choice(WORDS)}{draw.randrange(5000)}" for _ in range(n))


# names that operators use inside
CLASHING = ("row", "key", "n", "label", "words", "shard", "slot", "kept", "base", "spans", "term")


def frame(spark, rows, clashing=True):
    """Documents (doc_id, text, lang) with extra columns whose names clash with inner ones."""
    extra = CLASHING if clashing else ()
    schema = "doc_id long, text string, lang string" + "".join(f", `{c}` string" for c in extra)
    full = [(i, t, lang, *[f"{c} of {i}" for c in extra]) for i, t, lang in rows]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows and ids."""
    long_text = "\n".join(prose(k, 40) for k in range(400))
    return [
        (1, prose(1, 60), "en"),
        (2, prose(1, 60), "en"),
        (3, None, "en"),
        (4, "", "de"),
        (5, " \t\n ", None),
        (6, long_text, "en"),
        (7, "x" * 3000 + " tail", "fr"),
        (8, "one two", "en"),
        (9, "ONE  two", "en"),
        (9, "ONE  two", "en"),
        (9, prose(9, 30), "en"),
        (None, prose(1, 60), "en"),
        (None, None, None),
        (10, "Grüße 日本語 　 ab<|endoftext|> c\x00d 's ''  \r\n end ", "de"),
        (11, prose(11, 20) + " " + prose(12, 60), "en"),
        (12, prose(13, 5) + " " + prose(12, 60), "en"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
