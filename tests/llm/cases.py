"""Small tables with the awkward cases, and plain versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, size string, line int, word string, set long, shard int, copies int"


def some_documents(n: int = 120, seed: int = 3) -> list[tuple]:
    """Random texts with copies, near copies, shared lines and odd rows."""
    rng = random.Random(seed)
    letters = {"en": "the of and her tion", "de": "der und sch ein keit", "fr": "le eaux oi que é"}
    stems = {k: [a + b for a in v.split() for b in v.split()] for k, v in letters.items()}
    shared = " ".join(rng.choice(stems["en"]) + str(i) for i in range(30))
    rows: list[tuple] = []
    for i in range(n):
        lang = rng.choice(sorted(stems))
        lines = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.choice(stems[lang]) + rng.choice(stems[lang]) for _ in range(rng.randint(4, 25))]
            lines.append(" ".join(words).capitalize() + ".")
        if i % 9 == 0:
            lines.append(shared)
        text = "\n".join(lines)
        if rows and i % 6 == 0:  # a near copy
            words = rng.choice(rows)[1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if rows and i % 11 == 0:  # a copy
            text = rng.choice(rows)[1]
        rows.append((i, text, lang, f"s{i % 4}" if i % 3 else "hot"))
    rows += [
        (500, None, "en", "s1"),
        (501, "", "en", None),
        (502, " \t\n\x0b ", None, "s1"),
        (503, "one", "en", "s2"),
        (504, "one two three four", "en", "s2"),
        (505, "ONE two three FOUR", "en", "s2"),
        (506, "12 34 !!", "de", "s2"),
        (507, " ".join(f"long{k % 700}" for k in range(30_000)), "en", "s2"),
        (508, "x" * 200_000, "en", "s2"),
        (509, "日本語 テキスト \U0001f600 é", "en", "s2"),
        (7, rows[7][1], rows[7][2], rows[7][3]),  # a row that repeats
        (None, "nobody knows this id here", "en", "s3"),
        (None, None, None, None),
    ]
    return [(*row, "a", 1, "b", 2, 3, 4) for row in rows]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None) -> frozenset:
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    found = words(lowered)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def groups(rows: list[tuple], percent: int = 75) -> Counter:
    """``(doc_id, n_shingles, component_id)`` by comparing every pair."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    least: dict[int, list] = defaultdict(list)
    for i, row in enumerate(rows):
        least[top(i)].append(row[0])
    name = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return Counter((r[0], len(s), name[top(i)] if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def later_lines(rows: list[tuple], percent: int, least_words: int) -> set:
    """``(doc_id, line)`` of lines that match an earlier one, by all pairs."""
    found = []
    for doc_id, text in {(r[0], r[1]) for r in rows if r[1] is not None}:
        for i, line in enumerate(text.split("\n")):
            own = frozenset(words(line))
            if len(own) >= least_words:
                found.append(((-1 if doc_id is None else doc_id, i), own, (doc_id, i)))
    found.sort(key=lambda x: x[0])
    out = set()
    for i, (place, own, name) in enumerate(found):
        for other_place, other, _ in found[:i]:
            if other_place < place and 100 * len(own & other) >= percent * len(own | other):
                out.add(name)
                break
    return out
