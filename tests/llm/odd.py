"""Small documents with everything unusual, and brute-force versions of what operators compute."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PROSE = "The quick brown fox jumps over the lazy dog while it rains in the old town and nobody is at home to see it fall down"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, mix string, shard string, component_id string"


def documents() -> list[tuple]:
    """Null and empty texts, blank lines, repeated rows, near copies, one long text, unusual characters, a null source."""
    texts = {
        1: PROSE,
        2: PROSE,
        3: PROSE.replace("lazy", "sleepy"),
        4: None,
        5: "",
        6: " \t\n\x0b ",
        7: "one",
        8: "One two",
        9: "one two",
        10: "\n".join(f"line {i} of a long text says something new about item {i * i}" for i in range(300)),
        11: "Straße ÉCOLE naïve \U0001f600 emoji\x1cjoined words and <|endoftext|> in the midst",
        12: PROSE + "\n" + PROSE + "\nan own last line with other words",
        13: "x" * 3000,
        14: "mail me at a.b@c.example.org or call +1 (415) 555-2671, card 4111 1111 1111 1111, host 10.0.0.1",
    }
    rows = [(k, t, "en" if k % 2 else "fr", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "k", "m", "s", "c") for k, t in texts.items()]
    return [*rows, rows[0], rows[3]]


def shingles(text: str | None, k: int) -> frozenset:
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([("whole", *w)])


def linked(docs: list[tuple[int, str | None]], k: int, percent: int) -> dict[int, tuple[int, int]]:
    """n_shingles and component of each id, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    with_shingle: dict[tuple, list[int]] = {}
    for i in sorted(sets):
        shared = Counter(j for z in sets[i] for j in with_shingle.get(z, ()))
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for z in sets[i]:
            with_shingle.setdefault(z, []).append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeated(docs: list[tuple[int, str | None]], percent: int, least: int) -> dict[int, list[int]]:
    """Numbers of the lines that an earlier line of any document is similar to."""
    out: dict[int, list[int]] = {}
    seen: list[frozenset] = []
    by_word: dict[str, list[int]] = {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        for number, line in enumerate((text or "").split("\n")):
            own = frozenset(WORD.findall(line.lower()))
            if len(own) < least:
                continue
            shared = Counter(j for w in own for j in by_word.get(w, ()))
            if any(100 * n >= percent * (len(own) + len(seen[j]) - n) for j, n in shared.items()):
                out.setdefault(i, []).append(number)
            for w in own:
                by_word.setdefault(w, []).append(len(seen))
            seen.append(own)
    return out
