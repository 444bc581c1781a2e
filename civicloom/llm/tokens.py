"""Token ids of whole texts, and exact statistics of their lengths.

Texts are encoded by the ``tokenizers`` library. No token of a byte-level vocabulary runs from a
visible character into a following blank or out of what ``_UNITS`` divides, so the ids of a text
are those of its pieces one after the other: words cut at their marks, digits and line feeds as far
as bytes alone tell (``_pieces``). Pieces repeat, texts hardly do: each worker has the library encode
a piece when it first meets it, and gathers the rest with Arrow and numpy. Texts that hold runs of
blanks or an added token of the vocabulary (such as ``<|endoftext|>``, which the library's defaults
read as one id) go through the library whole.
"""

from __future__ import annotations

import string
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicloom.llm import workers

# Words remembered by one worker process. At half of it the words met since the last time become the
# older ones and the older ones are forgotten, so that frequent words stay; ids do not depend on it.
REMEMBERED_WORDS = 900_000
# Texts encoded together, in bytes; a longer text is a part of its own. A task holds many times as much.
PART_BYTES = 2_000_000
# Rows of a batch handed back to Spark.
ROWS_BACK = 512

# A blank beside more white space: the library decides what such a run belongs to.
_RUN = r" [\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]|[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}] "


class Coder:
    """Encodes texts with one tokenizer file; made inside a task. A file that divides texts in
    another way than ``_UNITS`` is refused."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(tokenizer)
        _require_byte_level(self._library, tokenizer)
        added = self._library.get_added_tokens_decoder().values()
        self._odd = "|".join([_RUN, *(regex.escape(token.content) for token in added)])
        self._units = regex.compile(_UNITS)
        self._tokenize = self._library.model.tokenize
        self._letters = _byte_letters()
        self._by_word, self._older = _remembered(tokenizer)

    def _whole(self, text: str) -> bytes:
        return array("I", self._library.encode(text, add_special_tokens=False).ids).tobytes()

    def _unit(self, text: str) -> bytes:
        """Ids of what the merge rules see as one."""
        letters, _ = charmap_decode(text.encode(), "strict", self._letters)
        return array("I", map(_token_id, self._tokenize(letters))).tobytes()

    def word(self, text: str) -> bytes:
        """Ids, as little-endian unsigned 32-bit numbers, of a word with its blank."""
        known = self._by_word.get(text)
        if known is None:
            known = self._older.get(text) or self._new(text)
            if len(self._by_word) >= REMEMBERED_WORDS // 2:
                self._older.clear()
                self._older.update(self._by_word)
                self._by_word.clear()
            self._by_word[text] = known
        return known

    def _new(self, text: str) -> bytes:
        letters = text[1:] if text[:1] == " " else text
        if letters.isalpha():
            return self._unit(text)
        if letters[-1:] in _MARKS and letters[:-1].isalpha():
            return self.word(text[:-1]) + self.word(text[-1])
        units = self._units.findall(text)
        return self._unit(text) if len(units) == 1 else b"".join(map(self.word, units))

    def encode_all(self, batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """Batches put together to parts, each with its ids and where each text ends.
        The last column of a batch holds the texts."""
        kept, size = [], 0
        for batch in _ending_with_none(batches):
            if batch is not None:
                added = batch.columns[-1].nbytes
            # A part ends before the batch that would make it too long: no short rest is left over.
            if kept and (batch is None or size + added > PART_BYTES):
                table = pa.Table.from_batches(kept).combine_chunks().to_batches()
                for whole in table:
                    row = 0
                    for ids, ends in self.encode(whole.columns[-1]):
                        yield whole.slice(row, len(ends)), ids, ends
                        row += len(ends)
                kept, size = [], 0
            if batch is not None:
                kept.append(batch)
                size += added

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Parts of the texts in order: the ids of a part, and where each text of it ends."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            floor = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, floor + PART_BYTES, "right")))
            yield self._part(texts[first:last])
            first = last

    def _part(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = np.flatnonzero(pc.match_substring_regex(texts, self._odd).to_numpy(zero_copy_only=False))
        kept = texts
        if len(odd):
            # One blank holds the place of a text that goes through the library whole.
            mask = np.zeros(len(texts), dtype=bool)
            mask[odd] = True
            kept = pc.if_else(pa.array(mask), pa.scalar(" ", pa.large_string()), texts)
        pieces, bounds = _pieces(kept)
        coded = pieces.dictionary_encode()
        known_word, new_word = self._by_word.get, self.word
        ids = [known_word(word) or new_word(word) for word in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        index = coded.indices.to_numpy()
        if len(odd):
            index = index.copy()
            index[bounds[odd]] = len(ids) + np.arange(len(odd))
            ids += [self._whole(texts[place].as_py()) for place in odd.tolist()]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        begins = np.cumsum(sizes) - sizes
        counts = sizes[index]
        ends = np.cumsum(counts)
        if len(ends) == 0:
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts), dtype=np.int64)
        narrow = np.int32 if max(ends[-1], len(flat)) < 1 << 31 else np.int64
        moved = np.repeat((begins[index] - (ends - counts)).astype(narrow), counts)
        moved += np.arange(ends[-1], dtype=narrow)
        return flat[moved], np.concatenate(([0], ends))[bounds[1:]]


# What a byte may stand for: unknown, letter, digit, mark, apostrophe, line feed, blank.
_UNKNOWN, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _LINE, _BLANK = range(7)


def _kinds() -> np.ndarray:
    """The kind of every byte. Marks are those of ASCII; other control characters stay unknown, and
    so does every byte beyond ASCII except the first ones of U+00C0 to U+027F and U+0400 to U+047F."""
    kinds = np.full(256, _UNKNOWN, dtype=np.uint8)
    kinds[33:127] = _MARK
    kinds[[ord(letter) for letter in string.ascii_letters]] = _LETTER
    kinds[[ord(digit) for digit in string.digits]] = _DIGIT
    kinds[ord("'")], kinds[ord("\n")], kinds[ord(" ")] = _APOSTROPHE, _LINE, _BLANK
    kinds[[*range(0xC3, 0xCA), 0xD0, 0xD1]] = _LETTER
    return kinds


def _divides() -> np.ndarray:
    """Whether a unit ends between two bytes, by 8 * kind of the first + kind of the second. After
    an apostrophe letters may go on, and a line feed ends a unit only where it is the whole of it."""
    divides = np.zeros((8, 8), dtype=bool)
    divides[:, _BLANK] = True
    visible = [_LETTER, _DIGIT, _MARK, _APOSTROPHE]
    divides[visible, _LINE] = True
    divides[_LETTER, [_DIGIT, _MARK, _APOSTROPHE]] = True
    divides[_DIGIT, [_LETTER, _MARK, _APOSTROPHE]] = True
    divides[_MARK, [_LETTER, _DIGIT]] = True
    divides[_APOSTROPHE, _DIGIT] = True
    return divides.reshape(-1)


_KINDS, _DIVIDES = _kinds(), _divides()


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut where bytes alone tell that ``_UNITS`` divides them (before blanks and at most marks,
    digits and line feeds), and how many pieces stand before each text and in all. No text holds a
    blank beside other white space."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    offsets, floor = offsets - offsets[0], int(offsets[0])
    size = int(offsets[-1])
    if not size:
        return pa.array([], pa.large_string()), np.zeros(len(offsets), dtype=np.int64)
    buffer = texts.buffers()[2].slice(floor, size)
    data = np.frombuffer(buffer, dtype=np.uint8)
    kinds = _KINDS[data]
    if data.max() > 127:
        follow = np.flatnonzero((data > 127) & (kinds == _LETTER)) + 1
        kinds[follow] = _LETTER
        # The signs of multiplication and division stand among the letters.
        signs = follow[(data[follow - 1] == 0xC3) & ((data[follow] == 0x97) | (data[follow] == 0xB7))]
        kinds[signs] = kinds[signs - 1] = _UNKNOWN
    begins = np.zeros(size + 1, dtype=bool)
    begins[1:-1] = _DIVIDES[kinds[:-1] << 3 | kinds[1:]]
    begins[offsets] = True
    lines = np.flatnonzero(kinds[:-1] == _LINE)
    after = kinds[lines + 1]
    begins[lines[begins[lines] & (after >= _LETTER) & (after <= _APOSTROPHE)] + 1] = True
    begins = np.flatnonzero(begins)
    pieces = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins.astype(np.int64, copy=False)), buffer)
    return pieces, np.searchsorted(begins, offsets)


# Where byte-level vocabularies of this kind divide a text.
_UNITS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Marks that follow letters as a unit of their own.
_MARKS = frozenset(".,;:!?")


def _remembered(tokenizer: str) -> tuple[dict[str, bytes], dict[str, bytes]]:
    """Words this worker process has met, kept from one task to the next: newer and older ones."""
    return workers.kept(f"words {tokenizer}", ({}, {}))


def _require_byte_level(library, name: str) -> None:
    from tokenizers import models, pre_tokenizers

    divides, model = library.pre_tokenizer, library.model
    if not (
        library.normalizer is None
        and isinstance(divides, pre_tokenizers.ByteLevel) and divides.use_regex and not divides.add_prefix_space
        and isinstance(model, models.BPE) and not model.dropout
        and not model.continuing_subword_prefix and not model.end_of_word_suffix
    ):
        raise ValueError(f"{name} is no byte-level vocabulary that divides texts by the plain pattern")


def _ending_with_none(batches):
    yield from batches
    yield None


_token_id = attrgetter("id")


def _byte_letters() -> str:
    """The letters that stand for the bytes from 0 on in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    letters = {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}
    return "".join(letters[byte] for byte in range(256))


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int | None, *,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id_col, ids)``: the ids of each whole text and ``end_id`` after them, as
    little-endian unsigned 32-bit numbers. A null text counts as empty. No shuffle."""
    plain = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    end = np.array([] if end_id is None else [end_id], dtype="<u4").tobytes()

    def run(batches):
        for batch, ids, ends in Coder(tokenizer).encode_all(batches):
            begins = np.concatenate(([0], ends[:-1]))
            coded = [ids[a:b].tobytes() + end for a, b in zip(begins, ends)]
            for row in range(0, len(coded), ROWS_BACK):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[row:row + ROWS_BACK], pa.array(coded[row:row + ROWS_BACK], pa.binary())],
                    names=[id_col, "ids"],
                )

    kind = plain.schema[id_col].dataType.simpleString()
    return plain.mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def token_count() -> Column:
    return F.octet_length("ids").cast("long") / F.lit(4)


def count_tokens(docs: DataFrame, tokenizer: str, *, text_col: str = "text") -> DataFrame:
    """One row ``(n_tokens)`` per document. A null text counts as empty: 0 tokens."""
    plain = docs.select(F.col(text_col).alias("_text"))

    def run(batches):
        for _, _, ends in Coder(tokenizer).encode_all(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(ends, prepend=0), pa.int64())], names=["n_tokens"])

    return plain.mapInArrow(run, "n_tokens long")


# Lengths that share a first-level sum of the suffix sums.
LENGTHS_PER_BLOCK = 1024


def length_histogram(counts: DataFrame, *, length_col: str = "n_tokens") -> DataFrame:
    """Exact statistics for every context limit, from one row per document.

    One row per length that occurs: ``n_tokens``, ``documents`` and ``tokens`` of that length,
    ``documents_longer`` and ``tokens_longer`` above it, ``documents_total``, ``tokens_total``,
    ``truncated_tokens`` (tokens kept if every document is cut at this length), ``lost_tokens``
    and ``quantile`` (share of documents not longer). A limit between two lengths answers from
    the row of the largest length not above it: add ``documents_longer * (limit - n_tokens)``.
    A null length is left out; no rows give no rows.

    The documents meet in partial sums only. The suffix sums run within blocks of lengths, and
    over the blocks' totals: no window sees more than one block or the list of blocks.
    """
    by_length = (
        counts.where(F.col(length_col).isNotNull())
        .groupBy(F.col(length_col).cast("long").alias("n_tokens"))
        .agg(F.count("*").alias("documents"))
        .withColumn("tokens", F.col("n_tokens") * F.col("documents"))
        .withColumn("_block", F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK))
    )
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("_block")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    blocks = by_length.groupBy("_block").agg(
        F.sum("documents").alias("_d"), F.sum("tokens").alias("_t")
    ).select(
        "_block",
        F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_d_after"),
        F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_t_after"),
        F.sum("_d").over(everything).alias("documents_total"),
        F.sum("_t").over(everything).alias("tokens_total"),
    )
    longer = (
        Window.partitionBy("_block").orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        by_length.join(blocks, "_block")
        .withColumn("documents_longer",
                    F.coalesce(F.sum("documents").over(longer), F.lit(0)) + F.col("_d_after"))
        .withColumn("tokens_longer",
                    F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("_t_after"))
        .withColumn("truncated_tokens", F.col("tokens_total") - F.col("tokens_longer")
                    + F.col("documents_longer") * F.col("n_tokens"))
        .select(
            "n_tokens", "documents", "tokens", "documents_longer", "tokens_longer",
            "documents_total", "tokens_total", "truncated_tokens",
            (F.col("tokens_total") - F.col("truncated_tokens")).alias("lost_tokens"),
            ((F.col("documents_total") - F.col("documents_longer")) / F.col("documents_total"))
            .alias("quantile"),
        )
    )
