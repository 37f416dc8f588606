import os
import sys

import numpy as np
import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
# Tests of the folder above may get this module by the name "conftest".
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path.insert(0, HERE)

SF_DIR = "/root/testdata/sf0.001"


def sentence(rng: np.random.Generator, n: int, size: int = 400) -> list[str]:
    return [f"w{i}" for i in rng.integers(0, size, n)]


@pytest.fixture(scope="session")
def tricky():
    """(doc_id, text): copies, near copies, shared passages, short, empty, null and long texts."""
    rng = np.random.default_rng(3)
    base, passage = sentence(rng, 220), sentence(rng, 130, 5000)
    docs = [(1, None), (2, ""), (3, "  \n\t "), (4, "One"), (5, "one"), (6, "one two three four")]
    docs += [(7, "ONE two\nthree four"), (8, "ein Öl ÖL"), (9, "ein öl ÖL")]
    key = 20
    for edits in (0, 0, 0, 1, 2, 3, 5, 8, 12, 20, 40):
        own = list(base)
        for at in rng.integers(0, len(own), edits):
            own[at] = f"x{rng.integers(0, 10**6)}"
        docs.append((key, " ".join(own)))
        key += 1
    for cut in range(6):
        own = sentence(rng, 60, 9000)
        own[30:30] = passage[cut * 3 : 130 - cut * 7]
        docs.append((key, "  ".join(own) + "\n"))
        key += 1
    docs.append((key, " ".join(passage[10:59])))  # one word short of a window
    docs.append((key + 1, " ".join(passage[10:60])))
    docs.append((key + 2, "Que " * 700))
    docs.append((key + 3, "Que " * 300))
    docs.append((key + 4, " ".join(sentence(rng, 9000, 20000)) + " " + " ".join(passage)))
    return docs


@pytest.fixture(scope="session")
def clashing(spark, tricky):
    """The same as a table, with a repeated row, and other columns named as the operators' own."""
    names = "key row_key doc class element member pivot shard words hash counts score ids rank"
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names.split())
    rows = [(key, text, *[None] * len(names.split())) for key, text in [*tricky, tricky[-6]]]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
