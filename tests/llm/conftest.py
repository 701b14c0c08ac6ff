import random

import pytest

WORDS = ["".join(random.Random(i).choice("abcdefghijklmnop") for _ in range(random.Random(i + 9).randint(2, 7))) for i in range(500)]


@pytest.fixture(scope="session")
def texts():
    """Documents with copies, near copies, shared passages, empty, null and very long texts."""
    r = random.Random(3)
    make = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    passage, line = make(60), make(9)
    out = []
    for i in range(90):
        parts = [make(r.randint(1, 60))]
        if i % 6 == 0:
            parts.append(passage)
        if i % 4 == 0:
            parts.append(line)
        out.append((i, "\n".join(parts)))
    out += [(100 + i, out[i][1]) for i in range(0, 30, 3)]
    long = make(900)
    out += [(200, long), (201, long.replace(WORDS[7], WORDS[8], 1)), (202, long + " x"), (203, make(20_000)), (204, ""), (205, None), (206, " \n\t "), (207, "é" * 500), (208, "ÀB " * 80), (209, out[0][1])]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, f"s{i % 3}" if i % 10 else None, i) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, kept int").repartition(3)


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, rows without an identifier, and columns with the names of results."""
    rows = [(1, "same", 1), (1, "same", 1), (2, "same", 1), (None, "same", 1), (None, "alone", 1), (None, "alone", 1), (3, None, None), (4, "", 2)]
    names = "doc_id long, text string, keep_id int"
    return spark.createDataFrame(rows, names).selectExpr("doc_id", "text", "keep_id", "keep_id AS source", "1 AS kept", "2 AS mix_order", "3 AS fingerprint", "4 AS n_lines", "5 AS xd_salt", "6 AS sequence_id")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
