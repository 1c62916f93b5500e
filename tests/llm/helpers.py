"""Odd documents, and the plain definitions that operators are held against."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and stone river light under green walk seven paper cloud north table glass quiet signal motor bread window".split()
#: Names that operators use themselves.
CLASHING = ("key", "score", "row", "digest", "ord", "tie", "n", "bucket", "id", "text_key", "copies", "ids", "range", "late", "word", "c", "y", "island", "size", "leaf", "_row", "_key")


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", "x" + str(rng.randrange(50))]) for _ in range(n))


def odd_rows(seed: int = 0, n: int = 60) -> list[tuple]:
    """Prose, exact and near copies, shared passages, null, empty and blank texts, marks, a long text, repeated rows, missing ids."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([3, 30, 80, 200])), "en", f"src{i % 4}") for i in range(n)]
    passage = prose(rng, 40)
    rows[5] = (5, rows[7][1], "en", "src0")
    rows[6] = (6, rows[7][1] + " end", "en", None)
    rows[8] = (8, "start " + passage + " then " + prose(rng, 20), "en", "src1")
    rows[9] = (9, prose(rng, 20) + " " + passage, "fr", "src1")
    rows += [
        (100, None, "en", "src1"), (101, "", None, ""), (102, "  \n\t ", "en", "src1"), (103, "One", "en", None), (104, "élan über ñandú 日本語 \U0001f600 " * 12, "fr", "src2"),
        (105, "ab" * 4000, "en", "src2"), (106, prose(rng, 9000), "en", "src3"), (None, "no id here " * 30, "en", "src0"), (None, "no id here " * 30, "en", "src0"), (107, rows[3][1], "en", "src3"), (107, rows[3][1], "en", "src3"), (107, "another text of the same id", "en", "src3"),
    ]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def frame(spark, rows, partitions: int = 3, extra: bool = False):
    d = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return d.withColumns({c: F.lit("x") for c in CLASHING}) if extra else d


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = [w for w in (text or "").encode().split()]
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def jaccard_links(texts: list[str | None], threshold: float = 0.8) -> set[tuple[int, int]]:
    sets = [shingles(t) for t in texts]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    common: dict = defaultdict(int)
    for held in by.values():
        for x in range(len(held)):
            for y in range(x + 1, len(held)):
                common[held[x], held[y]] += 1
    links = {p for p, c in common.items() if c / (len(sets[p[0]]) + len(sets[p[1]]) - c) >= threshold}
    return links | {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if (texts[i] or "") == (texts[j] or "")}


def repeats_removed(rows: list[tuple], length: int = 100) -> dict:
    """By (doc_id, text): what is left, and how many runs went. Ids ascending, null last; rows alike are one document."""

    seen, out = set(), {}
    for key in sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows}, key=lambda k: k[:2]):
        raw = key[2].encode()
        gone = [False] * (len(raw) + 1)
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                gone[p : p + length] = [True] * length
            else:
                seen.add(s)
        gone = gone[: len(raw)]
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[None if key[0] else key[1], key[2]] = (kept, runs)
    return out
