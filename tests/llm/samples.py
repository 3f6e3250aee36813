"""Small tables with every awkward case, and brute-force helpers."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, n_words string, size string, r string, row string, k string, kept string, taken string, spans string, vec_id string"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(r: random.Random, n: int) -> list[str]:
    syllables = ["an", "be", "Ça", "de", "é", "fi", "ñu", "ho", "日本", "jo", "KA", "lu"]
    return ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n)]


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows of SCHEMA: nulls, blanks, short and long texts, exact and near copies, shared passages, repeated rows."""
    r = random.Random(seed)
    passage = " ".join(words(r, 70))
    base = words(r, 150)
    texts: list[str | None] = [None, "", " \t\n", "one", "one two three", "one two three", "A b c d e", "a B c d e", "x " * 400, "z" * 900, "\n".join(["same line here"] * 5 + ["other", "", "other"])]
    for i in range(n):
        kind = i % 6
        own = words(r, r.randint(30, 220))
        if kind == 0:
            near = list(base)
            near[r.randrange(len(near))] = "edited"
            texts.append(" ".join(near))
        elif kind == 1:
            texts.append(" ".join(own[:40]) + "\n" + passage + "\n" + " ".join(own[40:]))
        elif kind == 2:
            texts += [" ".join(own)] * 2
        elif kind == 3:
            texts.append("### $$ " + " ".join(w + "%%%" for w in own))
        else:
            texts.append("\n".join(" ".join(own[j : j + 12]) for j in range(0, len(own), 12)))
    texts.append(" ".join(words(r, 30_000)))
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "b", "a", "é", "b"][i % 5], len(t or ""), *["x"] * 10) for i, t in enumerate(texts)]
    return rows + [rows[12], rows[12], (None, texts[12], "en", "b", 0, *["x"] * 10), (None, None, None, None, None, *[None] * 10)]


def table_of(spark, rows: list[tuple]):  # noqa: ANN001, ANN201
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def shingles(text: str | None, n: int = 5) -> set[tuple]:
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
