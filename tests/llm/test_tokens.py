"""Token ids against the library, lengths against plain counting, packing and token files."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from civicloom.llm import packing, queries, token_files, tokens
from civicloom.session import fresh_path
from tests.llm.small import documents, rows_of, sentence

ODD = ["", " ", "  ", " a", "a ", "a  b", "\n", "a\n b", "a \nb", "<|endoftext|> hi<|endoftext|>",
       "don't it's we'll", "日本 語。です", "a,b. c!? d;;", "é à", "　a 　", "tab\tx y\t z",
       "a\x1c b", "Ⅷ ²³ 1a", " ' s", "ab. 's", "\u0085 x", None, "x" * 5000, "word " * 3000,
       "hello <|endoftext|> world", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "<| endoftext|>",
       "(the", "\"the (the", ".st", "#include", "-ing 1st 2nd", "1the the1", "'the", "\x00the", "é\u0301a \u0301b"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def encoded(texts):
    coder, answer = tokens.Coder(queries.tokenizer_path()), []
    for ids, ends in coder.encode(pa.array(texts, pa.string())):
        answer += [part.tolist() for part in np.split(ids, ends[:-1])]
    return answer


def test_ids_of_odd_texts(library):
    assert encoded(ODD) == [library.encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tab.,'sté1! 　日"), max_size=14), min_size=1, max_size=5))
def test_ids_of_random_texts(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    assert encoded(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_an_added_token_is_one_id():
    assert encoded(["hello <|endoftext|> world", "plain"])[0] == [31373, 220, 50256, 995]


def test_a_file_that_divides_texts_otherwise_is_refused(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    other = Tokenizer.from_file(queries.tokenizer_path())
    other.pre_tokenizer = pre_tokenizers.Whitespace()
    other.save(str(tmp_path / "other.json"))
    with pytest.raises(ValueError, match="byte-level"):
        tokens.Coder(str(tmp_path / "other.json"))


def test_the_memory_may_start_anew(monkeypatch, library):
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(tokens, "PART_BYTES", 20)
    texts = ["one two three four, five", "two one six. seven", "eight nine\nten"]
    assert encoded(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_length_histogram(spark):
    lengths = [0, 0, 3, 3, 3, 7, 1024, 1025, 5000, 5000]
    counts = spark.createDataFrame([(n,) for n in lengths] + [(None,)], "n_tokens long")
    rows = {row["n_tokens"]: row for row in tokens.length_histogram(counts).collect()}
    assert sorted(rows) == sorted(set(lengths))
    for limit, row in rows.items():
        assert row["documents"] == lengths.count(limit)
        assert row["documents_longer"] == sum(n > limit for n in lengths)
        assert row["tokens_longer"] == sum(n for n in lengths if n > limit)
        assert row["truncated_tokens"] == sum(min(n, limit) for n in lengths)
        assert row["lost_tokens"] == sum(max(0, n - limit) for n in lengths)
        assert row["quantile"] == sum(n <= limit for n in lengths) / len(lengths)
        assert (row["documents_total"], row["tokens_total"]) == (len(lengths), sum(lengths))
    assert tokens.length_histogram(counts.limit(0)).collect() == []


def test_op4_counts_whole_texts(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    lengths = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    rows = queries.queries()["op4_token_counts"](spark, folder).collect()
    assert sum(r["documents"] for r in rows) == len(lengths)
    assert sorted((r["n_tokens"], r["documents"]) for r in rows) == sorted(
        (n, lengths.count(n)) for n in set(lengths))


def packed_rows(df):
    bins = {}
    for row in df.collect():
        bins.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return bins


def test_slack_uses_every_piece_once():
    rng = random.Random(1)
    for _ in range(30):
        counts = {rng.randint(1, 64): rng.randint(1, 20) for _ in range(rng.randint(1, 12))}
        used = {}
        for times, combination in packing.minimum_bin_slack(counts, 64):
            assert times > 0 and sum(length * n for length, n in combination) <= 64
            for length, n in combination:
                used[length] = used.get(length, 0) + times * n
        assert used == counts


def test_slack_finds_full_combinations():
    counts = {600: 10, 424: 10, 1024: 3, 512: 4, 300: 6, 100: 4, 24: 1}
    found = sum(times for times, _ in packing.minimum_bin_slack(counts, 1024))
    assert found == -(-sum(length * n for length, n in counts.items()) // 1024)


def test_slack_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        packing.minimum_bin_slack({1025: 1}, 1024)


def test_op1_places_every_token(spark, library):
    folder = "/root/testdata/sf0.001"
    df = queries.queries()["op1_best_fit_packing"](spark, folder)
    bins = packed_rows(df)
    want = set()
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)] if len(ids) > 1024 else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            want.add((row["doc_id"], piece, a, b - a, crc))
    got = rows_of(df, "doc_id", "piece", "start", "length", "ids_crc32")
    assert set(got) == want and len(got) == len(want)
    least = -(-sum(w[3] for w in want) // 1024)
    assert len(bins) <= least * 1.03 + 1


def test_packing_edges(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "long " * 4000), (4, "tie"), (5, "tie")]
    docs = documents(spark, rows).withColumn("sequence_id", F.lit(1)).withColumn("piece", F.lit("x"))
    df = queries.packed(docs)
    packed_rows(df)
    assert df.count() == 6 + 4
    assert sorted(r["length"] for r in df.where("doc_id = 3").collect()) == [930, 1024, 1024, 1024]
    assert queries.packed(docs.limit(0)).collect() == []


def test_sequences_are_filled_with_ids(spark, library):
    """Copies of a document, too, come out whole, each once; the pipeline's rows hold their ids."""
    rows = [(1, None), (2, "one two"), (2, "one two"), (2, "one two"), (None, "a b"), (3, "long " * 2500), (4, "tie")]
    docs = documents(spark, rows)
    found = queries.packed_sequences(docs).collect()
    got = []
    for row in found:
        ids, end = np.frombuffer(row["ids"], dtype="<u4").tolist(), 0
        assert len(ids) == row["n_tokens"] <= 1024
        for p in row["pieces"]:
            assert p["offset"] == end
            end += p["length"]
            got.append((p["doc_id"], p["piece"], p["start"], ids[p["offset"]:end]))
        assert end == len(ids)
    want = []
    for d, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        cuts = sorted({0, *range(len(ids) % 1024, len(ids), 1024), len(ids)})
        want += [(d, k, a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))] if len(ids) > 1024 else [(d, 0, 0, ids)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], np.frombuffer(r["ids"], dtype="<u4").tolist()) for r in pieces),
                  key=repr) == sorted(want, key=repr)
    assert queries.packed_sequences(docs.limit(0)).collect() == []


def test_a_frequent_length_is_dealt_out(spark):
    pieces = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(100).cast("long").alias("length"))
    df = packing.pack(pieces, 1024, order_by=["doc_id", "piece"])
    assert len(packed_rows(df)) == 500


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n, top in ((1, 1), (5, 2), (700, 40), (3000, 50257), (1200, 70000)):
        ids = rng.integers(0, top, n)
        matrix = token_files.WaveletMatrix.of(ids)
        assert (matrix.ids() == ids).all()
        assert [matrix.access(k) for k in range(0, n, 7)] == ids[::7].tolist()
        for token in {int(ids[0]), int(ids[-1]), 0, top + 5}:
            places = np.flatnonzero(ids == token)
            assert matrix.count(token) == len(places)
            assert matrix.count(token, n // 2) == (places < n // 2).sum()
            assert [matrix.select(token, k) for k in range(len(places))] == places.tolist()
            with pytest.raises(IndexError):
                matrix.select(token, len(places))
    assert len(token_files.WaveletMatrix.of(np.zeros(0, dtype=np.uint32)).ids()) == 0


@pytest.mark.parametrize("shard_tokens", [7, 1 << 21])
def test_token_files_round_trip(spark, library, shard_tokens):
    rng = random.Random(2)
    rows = [(k, sentence(rng, rng.randint(0, 40))) for k in range(60)]
    rows += [(None, "no id"), (7, "again"), (7, "again"), (200, None), (201, ""), (202, "long " * 3000)]
    docs = documents(spark, rows).withColumn("ids", F.lit(1)).repartition(5)
    path = fresh_path(spark, "test-files")
    token_files.write_token_files(docs, queries.tokenizer_path(), 0, path, shard_tokens=shard_tokens)
    read = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    ids_in_order = [r["doc_id"] for r in read]
    assert ids_in_order == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    start, texts = 0, {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(library.encode(text or "", add_special_tokens=False).ids + [0])
    for row in read:
        assert row["start"] == start and row["n_tokens"] * 4 == len(row["ids"])
        start += row["n_tokens"]
        assert np.frombuffer(row["ids"], dtype="<u4").tolist() in texts[row["doc_id"]]


def test_no_documents_no_files(spark):
    path = fresh_path(spark, "test-files")
    token_files.write_token_files(documents(spark, []), queries.tokenizer_path(), 0, path)
    assert token_files.read_token_files(spark, path).collect() == []


def test_op9_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = queries.queries()["op9_wavelet_token_files"](spark, folder).collect()
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows}
    start = 0
    for row in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids + [0]
        assert got.pop(row["doc_id"]) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert not got


def test_a_frequent_word_stays_remembered(monkeypatch):
    """However many rare words come between, it is divided by the merge rules once."""
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", 8)
    coder = tokens.Coder(queries.tokenizer_path())
    coder._by_word, coder._older = {}, {}
    divided, unit = [], coder._unit
    coder._unit = lambda text: divided.append(text) or unit(text)
    for rare in range(40):
        assert coder.word(" often") == unit(" often")
        coder.word(" " + chr(97 + rare % 26) * (rare + 1))
    assert divided.count(" often") == 1 and len(divided) == 41
    assert len(coder._by_word) + len(coder._older) <= 8


def test_marks_make_no_further_words(library):
    """What is remembered follows the units of the vocabulary, not the words with their marks and line feeds."""
    coder = tokens.Coder(queries.tokenizer_path())
    coder._by_word, coder._older = {}, {}
    letters = [f"{a}{b}ü" for a in "abcdefgh" for b in "éяklmnop"]
    marks = [".", ",", "!?", ".\n", "###", "(", "7", "-x"]
    texts = [" ".join(f"{word}{mark}" for word in letters) for mark in marks]
    got = [part.tolist() for ids, ends in coder.encode(pa.array(texts)) for part in np.split(ids, ends[:-1])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    # Each row of letters after a blank and at the begin of a line or text, and the marks.
    assert len(coder._by_word) <= 2 * len(letters) + 2 * len(marks)


def test_cuts_between_kinds_of_characters(library):
    coder = tokens.Coder(queries.tokenizer_path())
    kinds = [" ", "\n", "\n\n", "\r", "a", "s", "ll", "'", ".", "1", "é", "я", "×", "÷", "ʰ", "\u0301", "日", "。", "\u0085", "\x1c", "😀"]

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(kinds), max_size=12).map("".join), min_size=1, max_size=6))
    def same_ids(texts):
        got = [part.tolist() for ids, ends in coder.encode(pa.array(texts)) for part in np.split(ids, ends[:-1])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]

    same_ids()


def test_texts_in_a_slice_and_without_words(library):
    texts = pa.array(["left out", "", None, "é.é", "a  b", "", "x y\nz", "a  ", None, "left out"], pa.string()).slice(1, 8)
    got = [part.tolist() for ids, ends in tokens.Coder(queries.tokenizer_path()).encode(texts) for part in np.split(ids, ends[:-1])]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert encoded(["", None, ""]) == [[], [], []]
