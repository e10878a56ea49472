"""Awkward rows that every operator has to take: NULLs, empty and very long texts, ties, repeated rows, extra columns."""

from __future__ import annotations

import random

PASSAGE = " ".join(f"word{i}" for i in range(60))


def documents(seed: int = 3) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)

    def sentence(n: int) -> str:
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))

    base = [sentence(rng.randint(30, 90)) for _ in range(8)]
    docs: list[tuple[int | None, str | None]] = []
    for i in range(60):
        lines = [rng.choice(base) if rng.random() < 0.4 else sentence(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))]
        docs.append((i, "\n".join(lines)))
    near = docs[7][1].split(" ")
    near[len(near) // 2] = "changed"
    docs += [
        (100, None), (101, ""), (102, "   \n\t"), (103, docs[0][1]), (104, docs[0][1].replace(" ", "  ")), (105, " ".join(near)),
        (None, docs[1][1]), (None, None), (2, docs[2][1]), (2, docs[2][1]), (3, "other text under the same id, which is no copy"),
        (106, "a" * 30_000), (107, "ab " * 20_000), (108, PASSAGE), (109, "x " + PASSAGE + " y"), (110, "\n".join(["same line of five words"] * 40)),
        (111, "İstanbul ÉTÉ 12 été\r\nA\x0bB\x0cC"), (112, "%%% &&& ***"), (113, "<|endoftext|> and 's"), (114, "one two"), (115, "One, TWO!"),
    ]
    return docs


def frame(spark, rows=None):
    """The rows with columns beside id and text, some with names that results have too."""
    rows = documents() if rows is None else rows
    full = [(d, t, "en", "src", len(t or ""), float(i), "k", "w", "s") for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, "
                                       "key string, who string, sha string")


def empty(spark):
    return frame(spark, [])
