"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point and a seed. A letter trigram is the
element-wise product of its letters' vectors, permuted (cyclically shifted) by two, one and no places; a text is the
sum of its trigrams' vectors, a language prototype the sum of its texts' unit vectors. The prediction is the language whose
prototype has the largest cosine with the text.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import map_texts
from .unicode_classes import points

DIMENSIONS = 512
SEED = 20240229
MEMO_TRIGRAMS = 20_000
#: The sample that prototypes are learnt from: so many documents a language in the mean, and so many in all at most.
PER_LANGUAGE, IN_ALL = 1500, 30_000
UNDETERMINED = "und"


@cache
def is_letter() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[points("L")] = True
    return table


class TrigramSpace:
    """Vectors of trigrams, made when first met; a bounded memo."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self._letters: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, np.int64)  # sorted
        self.rows = np.empty(0, np.int64)
        self.vectors = np.empty((1024, self.dimensions), np.int8)

    def letter(self, point: int) -> np.ndarray:
        """The vector of a code point; 0 stands for a word's edge."""
        if point not in self._letters:
            if len(self._letters) >= MEMO_TRIGRAMS // 4:
                self._letters.clear()
            bits = np.random.Generator(np.random.PCG64([self.seed, point])).integers(0, 2, self.dimensions)
            self._letters[point] = (2 * bits - 1).astype(np.float32)
        return self._letters[point]

    def trigram(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of sorted, distinct keys."""
        if len(keys) > MEMO_TRIGRAMS:
            return np.stack([self.trigram(k) for k in keys.tolist()])
        at = np.searchsorted(self.keys, keys)
        known = (at < len(self.keys)) & (np.append(self.keys, -1)[at] == keys)
        if not known.all():
            if len(self.keys) + np.count_nonzero(~known) > MEMO_TRIGRAMS:
                self._clear()
                known[:] = False
            new, have = keys[~known], len(self.keys)
            while have + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
            for i, key in enumerate(new.tolist()):
                self.vectors[have + i] = self.trigram(key)
            merged = np.concatenate([self.keys, new])
            order = np.argsort(merged)
            self.rows = np.concatenate([self.rows, np.arange(have, have + len(new))])[order]
            self.keys = merged[order]
            at = np.searchsorted(self.keys, keys)
        return self.vectors[self.rows[at]].astype(np.float32)

    def text(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a whole text; None without a letter."""
        return self.measure(text)[0]

    def measure(self, text: str | None) -> tuple[np.ndarray | None, int]:
        """The unit vector of a whole text, and its trigrams; None and 0 without a letter."""
        if not text:
            return None, 0
        chars = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
        letters = is_letter()[chars]
        if not letters.any():
            return None, 0
        # Runs of other characters count as one edge; an edge stands before and after the text.
        points = np.concatenate([[0], np.where(letters, chars, 0), [0]]).astype(np.int64)
        edge = points == 0
        points = points[~(edge & np.concatenate([[False], edge[:-1]]))]
        keys, counts = np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:], return_counts=True)
        total = np.zeros(self.dimensions, np.float64)
        for k in range(0, len(keys), 4096):
            total += counts[k : k + 4096].astype(np.float32) @ self.lookup(keys[k : k + 4096])
        norm = np.sqrt(total @ total)
        return (total / norm if norm > 0 else total), int(counts.sum())


@cache
def space(dimensions: int, seed: int) -> TrigramSpace:
    return TrigramSpace(dimensions, seed)


def is_held_out(doc_id: Column) -> Column:
    """Whether a document takes no part in learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def learn_prototypes(
    docs: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL, dimensions: int = DIMENSIONS, seed: int = SEED
) -> dict[str, np.ndarray]:
    """{language: unit prototype} from documents with a language that aren't held out.

    The sample is bounded language by language: of each the documents whose hash falls below a share that leaves
    ``per_language`` in the mean (all where there are fewer), and the one with the smallest hash in any case. Where that
    would be more than ``in_all``, ``per_language`` is lowered to an equal share of it for each, so no language is left out.
    A document is a doc_id, its own language and its text: a row teaches no language but its own, and repeated rows count once.
    The prototypes reach the driver: ``dimensions`` numbers a language.
    """
    key = ["doc_id", "lang", "__of"]
    rows = docs.select("doc_id", "lang", F.xxhash64("text").alias("__of"), "text")
    rows = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    labelled = rows.select(*key).distinct()
    draw = F.pmod(F.xxhash64("doc_id", "__of"), F.lit(1 << 40)) / float(1 << 40)
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("first"))
    sums = counts.agg(F.count(F.lit(1)).alias("languages"), F.sum(F.least("n", F.lit(per_language))).alias("wanted"))  # one row
    each = F.when(F.col("wanted") > in_all, F.least(F.lit(per_language), in_all / F.col("languages"))).otherwise(per_language)
    shares = counts.join(F.broadcast(sums)).select("lang", "n", "first", each.alias("each"))
    sample = (
        labelled.join(shares, "lang")
        .where((draw * F.col("n") < F.col("each")) | (draw == F.col("first")))
        .select(*key)
    )
    texts = rows.join(F.broadcast(sample), key).dropDuplicates(key)

    def run(langs, values):
        sums: dict[str, np.ndarray] = {}
        for lang, value in zip(langs.to_pylist(), values, strict=True):
            vector = space(dimensions, seed).text(value)
            if vector is not None:
                sums[lang] = sums.get(lang, 0) + vector
        return [list(sums), [v.tolist() for v in sums.values()]]

    partial = map_texts(texts.selectExpr("lang AS doc_id", "text"), run, "lang string, vector array<double>")
    sums = (
        partial.select("lang", F.posexplode("vector").alias("at", "value"))
        .groupBy("lang", "at").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("vector"))
        .select("lang", F.col("vector.value").alias("vector"))
    )
    found = {r.lang: np.array(r.vector) for r in sums.collect()}
    return {k: v / n for k, v in sorted(found.items()) if (n := np.sqrt(v @ v)) > 0}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, 0 to 1) and trigrams (how many there are) of every whole text.

    ``und`` with score 0 where the text is null or has no letter, and where no language is known. A tie goes to the
    language that is first by name. Rows are independent: repeated rows get equal values, an empty table gives none.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names])

    def run(ids, texts):
        langs, scores, sizes = [], [], []
        for text in texts:
            vector, size = space(dimensions, seed).measure(text) if names else (None, 0)
            sizes.append(size)
            if vector is None:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            cosines = np.round(matrix @ vector, 9)
            best = int(np.argmax(cosines))
            langs.append(names[best])
            scores.append(float(np.clip(cosines[best], 0, 1)))
        return [ids, langs, scores, sizes]

    return map_texts(docs, run, "doc_id long, lang_pred string, score double, trigrams int")


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learn on what isn't held out, then predict every document from its text alone."""
    return identify(docs, learn_prototypes(docs)).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
