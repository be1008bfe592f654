import pytest

WORDS = "the of and miel café über tree stone river walks under über-alles light 42 Don't x9".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x // 65536 % len(WORDS)] + ("" if x // 97 % 5 else str(x % 50)))
    return " ".join(out)


#: (doc_id, text, lang, source): nulls, empty, blank, very long, ties, repeated rows.
ROWS = [
    (1, prose(1, 60), "en", "b"), (2, prose(1, 60), "en", "a"), (3, prose(2, 40) + " tail", "de", None),
    (3, prose(2, 40) + " tail", "de", None), (4, "", "en", "a"), (5, None, None, "a"), (6, " \n\t ", "en", "c"),
    (7, "Single", "en", "c"), (8, prose(3, 20000), "en", "d"), (None, prose(4, 30), "fr", "d"),
    (None, None, "fr", "d"), (9, "漢字かな交じり文 ไทย 🙂 İΣΣ <|endoftext|> don't", None, "d"), (10, "a" * 5000, "en", "a"),
    (3, prose(5, 25), "de", "b"), (11, "!!! 123 ...", "en", "e")]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns named like columns that operators make."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3, "doc_id")
    extra = "size key text_hash fp n_tokens row target grade expected_grade bucket rank position score_ around".split()
    return df.select("*", *[F.lit("extra").alias(c) for c in extra])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
