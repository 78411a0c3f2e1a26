import os
from types import SimpleNamespace

import pytest

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo".split()


def prose(seed, n):
    """n words without much order, the same for the same seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


@pytest.fixture
def docs(spark):
    def make(*texts, extra=False):
        rows = [(k, t, "en", "s", None) if not isinstance(t, tuple) else (*t, *(None,) * (5 - len(t))) for k, t in enumerate(texts)]
        df = spark.createDataFrame(rows, KINDS)
        if extra:
            # Names that operators use inside.
            for name in ("row", "word", "node", "label", "n", "c", "g", "_group", "_row", "_kept", "found", "print", "runs", "score", "kept", "piece"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture
def odd(docs):
    """Nulls in every column, empty and long texts, symbols only, repeated rows, ties."""
    long = prose(3, 60_000)
    return docs("", None, "   \n\t\n", "!!! ### $$$", "one", "one two", prose(1, 300), prose(1, 300), long, (None, None), (None, "null number " + prose(5, 90)),
                (6, prose(1, 300), "en", "s"), (70, "a" * 5000), (71, "a" * 5000), (72, "é" * 900), (73, "wört x y\x0bz"), extra=True)


@pytest.fixture(scope="session")
def tables(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SimpleNamespace(**{t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages", "benchmark", "labels")})
