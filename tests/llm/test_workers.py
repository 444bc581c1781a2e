"""What operators leave and hold in the memory of Python workers."""

import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from civicloom.llm import language, queries, tokens, workers
from tests.llm.small import documents, sentence


def peak(run):
    """Bytes that Python and numpy held at most while it ran, beyond what they held before."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_what_is_kept_is_forgotten_once_it_is_let_go():
    workers.kept("a name", []).append(1)
    assert workers.kept("a name", []) == [1]
    workers.let_go()
    assert workers.kept("a name", []) == []


def test_language_stages_let_go_of_the_words_of_encoders(spark):
    rng = random.Random(5)
    docs = documents(spark, [(k, sentence(rng, 20), "en", "a") for k in range(64)]).repartition(32).localCheckpoint()

    def words_kept():
        def run(batches):
            for batch in batches:
                kept = sum(name.startswith("_civicloom") and any(map(len, (
                    words for value in vars(module).values() if isinstance(value, tuple) for words in value)))
                    for name, module in list(sys.modules.items()))
                yield pa.RecordBatch.from_arrays([pa.array([kept] * batch.num_rows, pa.int64())], names=["n"])
        return docs.select("doc_id").mapInArrow(run, "n long").agg(F.sum("n")).first()[0]

    for stage in (lambda: language.learn(docs),
                  lambda: language.identify(docs, language.Languages([], np.zeros((0, 0)))).collect()):
        tokens.count_tokens(docs, queries.tokenizer_path()).collect()
        assert words_kept() > 0
        stage()
        assert words_kept() == 0


def test_an_encoder_holds_a_small_part_of_the_texts_at_a_time():
    text = " ".join(f"word{k % 100}" for k in range(2_000))
    texts = pa.array([text] * 500)  # 6 MB and more
    coder = tokens.Coder(queries.tokenizer_path())
    assert peak(lambda: [len(ids) for ids, _ in coder.encode(texts)]) < 60e6


def test_languages_hold_a_small_part_of_the_texts_at_a_time():
    rng = np.random.default_rng(3)
    letters = rng.integers(97, 123, 2_000_000, dtype=np.uint8).tobytes().decode()
    texts = pa.array([letters[k:k + 2_000] for k in range(0, len(letters), 2_000)])
    likelihood = rng.uniform(0.01, 1, (1 << language.GRAM_BITS, 12)).astype(np.float32)
    learned = language.Languages([f"l{k}" for k in range(12)], likelihood)
    assert peak(lambda: learned.predict(texts)) < 120e6
