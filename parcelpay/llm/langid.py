"""Language by cross-parsing entropy: the language whose text explains a document in the fewest phrases."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The bound of the training sample: documents of each language, characters of each document, characters of a language.
SAMPLE_DOCS, SAMPLE_DOC_CHARS, SAMPLE_CHARS = 200, 2_000, 30_000
#: Languages a model can hold.
MAX_LANGUAGES = 64
BLOCK = 512
LANES = 4_096
UNKNOWN = "und"


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of `codes`; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves


class Model:
    """Automata of all languages as one table: row (state), column (character), value twice the next state plus a bit.

    The bit is set where the longest match ends and a new phrase begins with the character.
    """

    def __init__(self, texts: Mapping[str, str]):
        self.languages = sorted(texts)
        letters = sorted({c for t in texts.values() for c in t.lower() if c.isalpha()})
        self.width = len(letters) + 2  # 0: between words, 1: any letter not seen in training
        self.code = np.zeros(0x110000, dtype=np.uint16)
        for block in range(0, 0x110000, 0x1000):
            self.code[block : block + 0x1000] = [chr(c).isalpha() for c in range(block, block + 0x1000)]
        for i, c in enumerate(letters):
            self.code[ord(c)] = i + 2
        tables, self.starts, base = [], [], 0
        for language in self.languages:
            moves = suffix_automaton(self.coded(texts[language]).tolist())
            first = moves[0]
            table = np.empty((len(moves), self.width), dtype=np.int32)
            table[:] = [2 * (base + first.get(c, 0)) + 1 for c in range(self.width)]
            for state, to in enumerate(moves):
                for c, t in to.items():
                    table[state, c] = 2 * (base + t)
            tables.append(table)
            self.starts.append(base)
            base += len(moves)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def coded(self, text: str) -> np.ndarray:
        """Letters by number, each run of other characters as one 0."""
        codes = self.code[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        return codes[~((codes == 0) & np.concatenate(([True], codes[:-1] == 0)))] if len(codes) else codes

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (row) under each language (column); texts are parsed in blocks of `BLOCK` characters."""
        owner = np.concatenate([np.full(-(-len(t) // BLOCK), i) for i, t in enumerate(texts)]).astype(np.int64)
        ends = np.concatenate([np.minimum(np.arange(BLOCK, len(t) + BLOCK, BLOCK), len(t)) - np.arange(0, len(t), BLOCK) for t in texts])
        flat = np.concatenate(texts)
        begin = np.concatenate(([0], np.cumsum(ends)))[:-1]
        order = np.argsort(-ends, kind="stable")
        total = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(order), LANES):
            lanes = order[a : a + LANES]
            at, size = begin[lanes], ends[lanes]
            state = np.repeat(np.array(self.starts, dtype=np.int64)[:, None], len(lanes), axis=1)
            count = np.ones((len(self.languages), len(lanes)), dtype=np.int64)
            for step in range(int(size[0])):
                live = int(np.searchsorted(-size, -step, side="left"))  # lanes longer than step
                value = self.table[state[:, :live] * self.width + flat[at[:live] + step]]
                count[:, :live] += value & 1
                state[:, :live] = value >> 1
            np.add.at(total, owner[lanes], count.T)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        coded = [self.coded(t or "") for t in texts]
        use = [i for i, c in enumerate(coded) if c.any()] if self.languages else []
        chars, part = 0, []
        for k, i in enumerate(use):
            part.append(i)
            chars += len(coded[i])
            if chars >= LANES * BLOCK or k + 1 == len(use):
                found = self.phrases([coded[j] for j in part]) / np.array([len(coded[j]) for j in part])[:, None]
                best = np.argmin(found, axis=1)
                for j, row, b in zip(part, found, best):
                    names[j] = self.languages[b]
                    rival = min(np.delete(row, b), default=None)
                    scores[j] = 1.0 if rival is None else float(rival / (rival + row[b]))
                chars, part = 0, []
        return names, scores


@lru_cache(maxsize=2)
def model(texts: tuple[tuple[str, str], ...]) -> Model:
    """One model for each Python worker and training sample."""
    return Model(dict(texts))


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learned from: the checksum of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[tuple[str, str], ...]:
    """Text to learn each language from: a bounded sample, the labelled documents with the smallest hashes of their ids."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("hash"), F.substring(F.col(text_col), 1, SAMPLE_DOC_CHARS).alias("text")
    )
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash", "text"))).filter(F.col("rank") <= SAMPLE_DOCS)
    texts: dict[str, str] = {}
    for row in first.orderBy("lang", "rank").collect():
        texts[row["lang"]] = (texts.get(row["lang"], "") + "\n" + row["text"])[:SAMPLE_CHARS]
    if len(texts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return tuple(sorted(texts.items()))


def identify(docs: DataFrame, learned: tuple[tuple[str, str], ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of each row of `docs`, from its whole text alone.

    Texts are parsed, per language, into the longest phrases that occur in the language's training text; the fewest
    phrases for each character win, the first language by name on a tie. The score is the rival's share of the phrases
    of both. Null texts, texts without a letter, and all texts where nothing was learned get `und` and 0. Repeated rows
    each give a row; other columns are not read.
    """

    def predicted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = model(learned)
        for batch in batches:
            names, scores = known.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(predicted, f"doc_id {kind}, lang_pred string, score double")
