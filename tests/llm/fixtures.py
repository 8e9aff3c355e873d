"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import random

WORDS = [
    "river", "stone", "light", "garden", "Window", "paper", "cloud", "market", "silver", "morning",
    "engine", "forest", "bridge", "candle", "Harbor", "island", "kitchen", "ladder", "meadow", "needle",
    "orange", "pencil", "quartz", "ribbon", "saddle", "timber", "valley", "wagon", "yellow", "zephyr",
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(60):
        rows.append((i, sentence(rng, rng.randint(30, 120))))
    for i in range(60, 90):
        noisy = " ".join(w + rng.choice(["###", "&&&", "$$$"]) for w in sentence(rng, 50).split())
        rows.append((i, noisy))
    base = rows[3][1]
    rows += [(100, base), (101, base + " extra"), (102, base.upper()), (103, base.replace(" ", "\n"))]
    rows += [(110, None), (111, ""), (112, "   \n\t "), (113, "one"), (114, "One"), (115, "two words")]
    rows += [(120, sentence(rng, 30_000)), (121, "é" * 5000), (122, "日本 語 x\x00y"), (123, "▁ a ▁b  c ")]
    rows += [(130, rows[5][1]), (130, rows[5][1]), (None, rows[6][1]), (None, None)]
    return rows


def documents(spark):
    data = [(i, t, None if (i or 0) % 7 else "en", "src", len(t or ""), 0.5, "x") for i, t in texts()]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    data = [(i, int(i < 60), 0) for i in range(90) if i % 2 == 0] + [(None, 1, 1), (5000, 1, 0), (2, 1, 0)]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")
