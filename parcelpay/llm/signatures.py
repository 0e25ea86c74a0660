"""Signatures of shingle sets: segments of the hash universe by size band, one-deletion neighbourhoods, empty subsets.

Two sets of sizes x <= y link when their symmetric difference is at most H = (100 - p)(x + y) / (100 + p), p the
percentage of the threshold. The universe of hashes is cut into m segments. A segment with tolerance 0 agrees when it is
equal in both sets, one with tolerance 1 also when the sets differ there by one element. If the tolerances plus one add
up to H + 1 + spare, the agreeing segments of every linked pair weigh more than `spare`. So either one that is not
trivial agrees, which both sets index by its value (or the value less one element), or enough trivial ones (empty, or of
at most one element under tolerance 1) do. Sets that share s of their trivial segments share `TOGETHER` of the first
t - s + TOGETHER, t their own number in a common order, so both index the subsets of TOGETHER of these.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import ceil, exp, inf, sqrt

import numpy as np

RATIO = 1.3
#: The chance that two unrelated sets of three-word shingles agree on one element's place, and the cost of a candidate in
#: index entries. Both weigh schemes only: every scheme brings all linked pairs together.
AGREE, CANDIDATE_COST = 0.1, 50
#: How many trivial segments make a signature.
TOGETHER = 3


def allowed(x: int, y: int, percent: int) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return (100 - percent) * (x + y) // (100 + percent)


@dataclass(frozen=True)
class Scheme:
    """Segments, how many of them (the last ones) tolerate one difference, and how many trivial ones count."""

    segments: int
    loose: int
    subset: int


def agreement(shingle: int) -> float:
    """The chance for shingles of so many words: each word after the first has to agree too."""
    return AGREE ** ((shingle - 1) / 2)


def allocate(low: int, high: int, docs: int, percent: int, agree: float = AGREE) -> Scheme:
    """The cheapest split of tolerances for sets of `low` to `high` elements, `docs` of them: index entries plus candidates."""
    h = allowed(high, high, percent)
    if h == 0:
        return Scheme(0, 0, 0)  # only equal sets link
    best, least = None, inf
    for part in (0, 8, 4, 2, 1):
        spare = 1
        for _ in range(8):  # the spare follows the number of empty segments to expect
            units = h + 1 + spare
            loose = units // (2 * part) if part else 0
            m = units - loose
            empty = m * exp(-low * percent / 100 / m)  # of the smallest set that the band's sets link with
            spare = max(spare, 1 + ceil(min(2 * empty, empty + 8 * sqrt(empty))))
        units = h + 1 + spare
        loose = units // (2 * part) if part else 0
        m = units - loose
        mean = (low + high) / 2 / m
        entries = (m - loose) + loose * (1 + mean)
        chance = docs * agree ** (low / m)
        cost = docs * entries * (1 + CANDIDATE_COST * chance)
        if cost < least:
            best, least = Scheme(m, loose, (spare + 1 + 1) // 2 if loose else spare + 1), cost
    return best


class Bands:
    """Size bands and the scheme of each. A band's scheme serves the pairs whose larger set lies in it."""

    def __init__(self, largest: int, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, ceil(edges[-1] * RATIO)))
        self.edges = np.array(edges, dtype=np.int64)
        self.schemes: list[Scheme] = []

    def plan(self, docs_by_band: dict[int, int], agree: float = AGREE) -> "Bands":
        e = self.edges.tolist()
        self.schemes = [allocate(a, b - 1, docs_by_band.get(i, 0) + 1, self.percent, agree) for i, (a, b) in enumerate(zip(e, e[1:]))]
        return self

    def expected(self, docs_by_band: dict[int, int]) -> float:
        """About how many signatures the sets have, each in the scheme of its own band and in that of the next one."""
        total = 0.0
        for band, docs in docs_by_band.items():
            for scheme in self.schemes[band : band + 2]:
                mean = float(self.edges[band]) / max(1, scheme.segments)
                total += docs * (scheme.segments + scheme.loose * mean)
        return total

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, side="right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def signatures(values: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of some sets, given one after the other in `values` (uint64), and the number of the set of each."""
    found, owner = [], []
    first = bands.of(sizes)
    last = np.minimum(bands.of(100 * sizes // bands.percent), len(bands.schemes) - 1)
    m_of, loose_of, subset_of = (np.array([getattr(s, k) for s in bands.schemes], dtype=np.int64) for k in ("segments", "loose", "subset"))
    for step in range(int((last - first).max(initial=-1)) + 1):
        scheme = first + step
        use = (sizes > 0) & (scheme <= last)
        use[use] = m_of[scheme[use]] > 0
        if not use.any():
            continue
        docs = np.flatnonzero(use)
        own, n, scheme = values[np.repeat(use, sizes)], sizes[docs], scheme[docs]
        m = m_of[scheme]
        start = np.concatenate(([0], np.cumsum(m)))
        row = np.repeat(start[:-1], n) + ((own >> np.uint64(1)) % np.repeat(m, n).astype(np.uint64)).astype(np.int64)
        part = mixed(own)
        total, count = np.zeros(start[-1], dtype=np.uint64), np.bincount(row, minlength=start[-1])
        np.add.at(total, row, part)
        doc = np.repeat(np.arange(len(docs)), m)
        place = np.arange(start[-1]) - start[doc]
        tag = mixed(scheme[doc].astype(np.uint64) << np.uint64(32) | place.astype(np.uint64))
        loose = place >= (m - loose_of[scheme])[doc]
        full = count > 0
        found.append(mixed(total[full] ^ tag[full]))
        owner.append(docs[doc[full]])
        less = loose[row] & (count[row] > 1)
        at = row[less]
        with np.errstate(over="ignore"):
            found.append(mixed((total[at] - part[less]) ^ tag[at]))
        owner.append(docs[doc[at]])
        trivial = np.flatnonzero((count == 0) | (loose & (count <= 1)))
        many = np.bincount(doc[trivial], minlength=len(docs)) >= subset_of[scheme]
        for d in np.flatnonzero(many):
            own_tags = np.sort(tag[trivial[doc[trivial] == d]]).tolist()
            least = int(subset_of[scheme[d]])
            together = min(least, TOGETHER)
            ahead = own_tags[: len(own_tags) - least + together]
            sums = [sum(c) & 0xFFFFFFFFFFFFFFFF for c in combinations(ahead, together)]
            found.append(mixed(np.array(sums, dtype=np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))
            owner.append(np.full(len(sums), docs[d]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


def sketch(values: np.ndarray, percent: int) -> np.ndarray:
    """Parities of the number of elements in each of 64, 128, 256 … places, as 64-bit words.

    Sets that differ in d elements have sketches that differ in at most d bits. The more places for each difference
    allowed, the fewer pairs just beyond the limit pass; large sets get eight, small ones sixteen.
    """
    bits, limit = 64, allowed(len(values), len(values), percent)
    while bits < (16 if bits < 512 else 8) * limit:
        bits *= 2
    odd = np.bincount((mixed(values) % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """Sketches (rows) brought down to `n` words."""
    while words.shape[1] > n:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def near(n_a: np.ndarray, n_b: np.ndarray, a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """For each pair of sets of these sizes and sketches, whether it is not ruled out."""
    ok = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    limit = (100 - percent) * (n_a + n_b) // (100 + percent)
    kinds: dict[tuple[int, int], list[int]] = {}
    for i in np.flatnonzero(ok).tolist():
        kinds.setdefault((len(a[i]), len(b[i])), []).append(i)
    for (x, y), rows in kinds.items():
        n = min(x, y)
        apart = np.bitwise_count(folded(np.stack([a[i] for i in rows]), n) ^ folded(np.stack([b[i] for i in rows]), n)).sum(axis=1)
        ok[rows] = apart <= limit[rows]
    return ok


def likely(sizes: np.ndarray, sketches: list[np.ndarray], group: np.ndarray, side: np.ndarray, percent: int):
    """Pairs (i, j) of different groups and of sides 0 and 1 (or of any side, where all rows are of side 0) that sizes and
    sketches don't rule out."""
    by_words: dict[int, np.ndarray] = {}
    length = np.array([len(s) for s in sketches])
    for w in set(length.tolist()):
        by_words[w] = np.flatnonzero(length == w)
    stacked = {w: np.stack([sketches[i] for i in rows]) for w, rows in by_words.items()}
    two = bool(side.any())
    for i in range(len(sizes)):
        if two and side[i]:
            continue
        for w, rows in by_words.items():
            keep = (group[rows] != group[i]) & ((side[rows] == 1) if two else (rows > i))
            small, large = np.minimum(sizes[rows], sizes[i]), np.maximum(sizes[rows], sizes[i])
            keep &= 100 * small >= percent * large
            if not keep.any():
                continue
            n = min(w, length[i])
            a, b = folded(sketches[i][None, :], n), folded(stacked[w][keep], n)
            apart = np.bitwise_count(a ^ b).sum(axis=1)
            ok = apart <= (100 - percent) * (sizes[rows[keep]] + sizes[i]) // (100 + percent)
            for j in rows[keep][ok]:
                yield i, int(j)
