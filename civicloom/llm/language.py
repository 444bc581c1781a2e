"""Language of documents, as mixtures of the languages of a labelled corpus.

Each learned language is a distribution over hashed letter n-grams, counted over all labelled
documents. A document is a mixture of languages: expectation-maximisation finds the proportions
under which its n-grams are likeliest. Sets of the strongest 1, 2, ... languages are fitted each,
and the one whose likelihood, less a charge per language, is largest is selected; the prediction
is the language with the largest proportion in it, the score that proportion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm import workers

GRAM_BITS = 16
UNDETERMINED = "und"
# Texts counted together, in bytes: a task holds a few numbers per n-gram of them and language.
PART_BYTES = 1 << 18
# A text's set stops growing after so many sizes in a row that do not explain it better.
MISSES = 2
ROUNDS_ALL = 12
ROUNDS_SET = 8
# Weight of the corpus-wide distribution in a language's own, in n-grams.
BACKGROUND = 50.0
# Charge per language of a set, times half the logarithm of the number of n-grams.
CHARGE = 2.0


def _letters() -> np.ndarray:
    """What a byte counts as: lower-case letters and all bytes of other scripts as themselves,
    everything else as a blank."""
    table = np.full(256, 32, dtype=np.uint32)
    table[97:123] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def _hashed(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of three bytes that hold at most one blank, and where they begin."""
    kinds = _letters()[raw]
    codes = kinds[:-2] << 16 | kinds[1:-1] << 8 | kinds[2:]
    blank = (kinds == 32).astype(np.uint8)
    places = np.flatnonzero(blank[:-2] + blank[1:-1] + blank[2:] <= 1)
    return codes[places] * np.uint32(0x9E3779B1) >> np.uint32(32 - GRAM_BITS), places


def gram_counts(texts: pa.Array):
    """Hashed n-grams of whole texts in lower case, a part of the texts at a time: the first and
    the last row of the part, and for each of its rows and n-grams the row, the code and how often
    it occurs, in order. A null text has none. A part holds about ``PART_BYTES``; a longer text
    is a part of its own and is counted piece by piece, so memory does not grow with it."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + PART_BYTES, "right")) - 1)
        part, own = raw[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        if last == first + 1:
            total = np.zeros(1 << GRAM_BITS, dtype=np.int64)
            for begin in range(0, len(part) - 2, PART_BYTES):
                codes, _ = _hashed(part[begin:begin + PART_BYTES + 2])
                total += np.bincount(codes, minlength=1 << GRAM_BITS)
            code = np.flatnonzero(total)
            yield first, last, np.full(len(code), first), code, total[code]
        elif len(part) > 2:
            codes, places = _hashed(part)
            row = np.searchsorted(own, places, side="right") - 1
            inside = places + 2 < own[row + 1]  # not those that run into the next text
            keys, count = np.unique(row[inside] << GRAM_BITS | codes[inside], return_counts=True)
            yield first, last, first + (keys >> GRAM_BITS), keys & ((1 << GRAM_BITS) - 1), count
        else:
            none = np.zeros(0, dtype=np.int64)
            yield first, last, none, none, none
        first = last


@dataclass
class Languages:
    """Learned languages and, for each n-gram, its likelihood under each, relative to the largest."""

    names: list[str]
    likelihood: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, list[list[str]], list[list[float]]]:
        """For each text: the language, its score, the selected languages and their proportions."""
        rows = len(texts)
        lettered = np.fromiter((_has_letter(t) for t in texts.to_pylist()), dtype=bool, count=rows)
        known = np.zeros((rows, len(self.names)), dtype=np.float64)
        if self.names:
            for _, _, row, code, count in gram_counts(texts):
                if len(code):
                    present, starts = np.unique(row, return_index=True)
                    known[present] = _Fit(self.likelihood[code], count.astype(np.float32), starts).select()
        # A text whose letters make no n-gram tells nothing: every language is as likely.
        if len(self.names):
            silent = known.sum(axis=1) == 0
            known[silent] = 1.0 / len(self.names)
        languages, scores, sets, shares = [], np.zeros(rows), [], []
        for k in range(rows):
            if not lettered[k] or not self.names:
                languages.append(UNDETERMINED), sets.append([]), shares.append([])
                continue
            order = [int(j) for j in np.argsort(-known[k], kind="stable") if known[k, j] > 0]
            languages.append(self.names[order[0]])
            scores[k] = min(1.0, float(known[k, order[0]]))
            sets.append([self.names[j] for j in order])
            shares.append([float(known[k, j]) for j in order])
        return languages, scores, sets, shares


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class _Fit:
    """Mixtures for the texts of one batch at a time. ``starts`` says where a text's n-grams begin."""

    def __init__(self, likelihood: np.ndarray, counts: np.ndarray, starts: np.ndarray):
        self.likelihood, self.counts, self.starts = likelihood, counts, starts
        self.sizes = np.diff(np.append(starts, len(counts)))
        self.total = np.add.reduceat(counts.astype(np.float64), starts)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, axis=0)

    def rounds(self, shares: np.ndarray, n: int) -> np.ndarray:
        for _ in range(n):
            joint = np.repeat(shares, self.sizes, axis=0) * self.likelihood
            joint *= (self.counts / np.maximum(joint.sum(axis=1), 1e-30))[:, None]
            shares = (self._sums(joint) / self.total[:, None]).astype(np.float32)
        return shares

    def fitness(self, shares: np.ndarray) -> np.ndarray:
        mixed = (np.repeat(shares, self.sizes, axis=0) * self.likelihood).sum(axis=1)
        return self._sums(self.counts * np.log(np.maximum(mixed, 1e-30)))

    def select(self) -> np.ndarray:
        texts, languages = len(self.starts), self.likelihood.shape[1]
        alone = self._sums(self.counts[:, None] * np.log(self.likelihood))
        everything = self.rounds(np.full((texts, languages), 1 / languages, dtype=np.float32), ROUNDS_ALL)
        # Strongest first; the language that explains the text best alone comes before all.
        strength = everything.copy()
        strength[np.arange(texts), alone.argmax(axis=1)] += 2
        order = np.argsort(-strength, axis=1, kind="stable")
        charge = CHARGE * 0.5 * np.log(np.maximum(self.total, 2))
        best = np.zeros((texts, languages), dtype=np.float32)
        best[np.arange(texts), order[:, 0]] = 1
        value = alone.max(axis=1) - charge
        misses = np.zeros(texts, dtype=int)
        for size in range(2, languages + 1):
            if (misses >= MISSES).all():
                break
            chosen = np.zeros((texts, languages), dtype=np.float32)
            np.put_along_axis(chosen, order[:, :size], 1 / size, axis=1)
            shares = self.rounds(chosen, ROUNDS_SET)
            fitness = self.fitness(shares) - size * charge
            better = (fitness > value) & (misses < MISSES)
            best[better], value[better] = shares[better], fitness[better]
            misses = np.where(better, 0, misses + 1)
        return best.astype(np.float64)


def learn(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Count n-grams over all rows with a language; null texts and null languages teach nothing.

    Tasks count, partial sums meet by language and n-gram; the driver gets at most
    2**GRAM_BITS numbers per language.
    """
    plain = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("_text"))

    def run(batches):
        workers.let_go()
        counted: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for _, _, row, code, count in gram_counts(batch.column(1)):
                language = index[row]
                for k in np.unique(language):
                    of = language == k
                    own = np.bincount(code[of], weights=count[of], minlength=1 << GRAM_BITS).astype(np.int64)
                    counted[names[k]] = counted[names[k]] + own if names[k] in counted else own
        for name, counts in counted.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()),
                 pa.array(counts[seen], pa.int64())], names=["lang", "gram", "n"])

    counts = plain.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")).toPandas()
    names = sorted(counts["lang"].unique())
    table = np.zeros((1 << GRAM_BITS, len(names)))
    for k, name in enumerate(names):
        own = counts[counts["lang"] == name]
        table[own["gram"], k] = own["n"]
    if not names:
        return Languages([], table.astype(np.float32))
    totals = table.sum(axis=0)
    # Languages weigh alike in the background, however many documents each has.
    background = (table / np.maximum(totals, 1)).mean(axis=1, keepdims=True)
    share = (table + BACKGROUND * background) / (totals + BACKGROUND)
    largest = share.max(axis=1, keepdims=True)
    likelihood = np.where(largest > 0, share / np.where(largest > 0, largest, 1), 1.0)
    return Languages(names, np.maximum(likelihood, 1e-6).astype(np.float32))


def identify(docs: DataFrame, languages: Languages, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``languages`` and ``proportions``.

    Only the text decides. A null text, or one without a letter, is ``und`` with score 0 and no
    languages, and so is everything if no language was learned. Columns of those names in
    ``docs`` are replaced. Whole texts; no shuffle.
    """
    model = docs.sparkSession.sparkContext.broadcast((languages.names, languages.likelihood))
    added = ["lang_pred", "score", "languages", "proportions"]
    kept = [c for c in docs.columns if c not in added]
    plain = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("_text"))

    def run(batches):
        workers.let_go()
        learned = Languages(*model.value)
        for batch in batches:
            best, scores, sets, shares = learned.predict(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(best, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))],
                names=[*kept, *added])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return plain.mapInArrow(
        run, f"{schema}, lang_pred string, score double, languages array<string>, proportions array<double>")
