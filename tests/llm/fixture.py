"""A small corpus with every awkward case, and brute-force versions to hold operators against."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, key string, chunk string, minimiser long, cid long"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 6))) for _ in range(words))


def corpus() -> list[tuple]:
    """Null, empty and blank texts, null and repeated ids, copies, near copies, shared passages, a long text."""
    passage, base = prose(1, 60), prose(2, 120)
    words = base.split(" ")
    near = " ".join(words[:50] + ["zz"] + words[51:])
    far = " ".join(w if i % 4 else "q" for i, w in enumerate(words))
    texts = [
        (1, base), (2, base), (3, near), (4, far), (5, None), (6, ""), (7, " \t\n "),
        (8, f"{prose(3, 40)}\n{passage} {prose(4, 20)}"), (9, f"{prose(5, 7)}  {passage}\n"),
        (10, passage + " " + passage), (11, prose(6, 34)), (12, prose(7, 35)), (13, "one two"), (14, "One  TWO"),
        (None, prose(8, 50)), (None, prose(8, 50)), (None, None), (15, base), (15, base),
        (16, "é ü 日本 " * 30), (17, "same " * 80), (18, prose(9, 4000)), (19, "x" * 5000), (20, " a　b"),
    ]
    lines = [prose(100 + i, 6) for i in range(12)]
    texts += [
        (30, "\n".join(lines)), (31, "\n".join([prose(200, 5), *lines])), (32, "\n".join(lines[3:] + lines[3:])),
        (33, "\n\n\n"), (34, lines[0]), (35, lines[0]),
    ]
    texts += [(40 + i, prose(300 + i // 2, 30 + i) + " " + passage[: 10 * i]) for i in range(12)]
    return [(i, t, "en", f"k{n}", None, n, None) for n, (i, t) in enumerate(texts)]


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def by_row(rows, columns: list[str]) -> list[tuple]:
    """Rows as tuples, sorted; for comparing without regard to order."""
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)
