from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "sa") for b in ("ta", "vo", "xi", "zen", "é")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, spans int"


def prose(rng: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + rng.choice(WORDS))
        if rng.random() < 0.1:
            out[-1] += "." if rng.random() < 0.7 else ".\n"
    return " ".join(out)


def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, periodic and very long texts, empty and null cells."""
    rng = random.Random(4)
    docs = [prose(rng, rng.randint(5, 120)) for _ in range(40)]
    base = prose(rng, 200)
    passage = prose(rng, 70)
    docs += [base] * 12
    for i in range(12):
        words = base.split(" ")
        words[10 * i] = "changed"
        docs.append(" ".join(words))
    docs += [prose(rng, 20) + ". " + passage + " " + prose(rng, 10) for _ in range(5)]
    docs += ["", "   ", "one", "one", "two words", "ab" * 900, "same line here\n" * 60, "ÄÖÜ é x"]
    docs.append(prose(rng, 6000))
    rows: list[tuple[int | None, str | None]] = list(enumerate(docs))
    rows += [(900, None), (None, base), (None, None), (3, docs[3])]
    return rows


def frame(spark, rows):
    """Documents with columns whose names clash with those of the operators' reports."""
    full = [(i, t, "en", "s", len(t or ""), "clash", 7) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="package")
def rows():
    return corpus()


@pytest.fixture(scope="package")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="package")
def none(spark):
    return frame(spark, []).limit(0)
