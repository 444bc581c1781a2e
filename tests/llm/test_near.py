"""Near-duplicate lines, documents and vectors, and neighbours, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicloom.llm import lines, minhash, neardup_vectors, neighbours, queries
from civicloom.llm.components import components
from tests.llm.small import Sets, documents, rows_of, sentence


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def changed(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[at] = rng.choice("xyzé")
        elif kind < 0.7:
            chars.insert(at, rng.choice("qwé"))
        else:
            del chars[at]
    return "".join(chars)


def test_components(spark):
    rng = random.Random(4)
    for n, m in ((30, 20), (200, 150), (60, 59)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        if m == n - 1:  # a path
            links = [(k, k + 1) for k in range(m)]
        sets = Sets(range(n))
        for a, b in links:
            sets.join(a, b)
        df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
        got = dict(rows_of(components(df), "id", "component_id"))
        assert got == {k: sets.find(k) for k in {x for link in links if link[0] != link[1] for x in link}}
    assert components(df.limit(0)).collect() == []


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_within_edits(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("abcdé ") for _ in range(rng.randint(16, 40)))
        b = changed(rng, a, rng.randint(0, edits + 2))
        pairs.append(tuple(sorted((a, b), key=len)))
    df = spark.createDataFrame(pairs, "s string, l string")
    want = sorted(p for p in pairs if distance(*p) <= edits)
    assert 0 < len(want) < len(pairs)
    assert sorted(map(tuple, lines.within_edits(df, "s", "l", edits).collect())) == want


def expected_lines(rows, edits, min_chars):
    """Line numbers that go, by document."""
    places = {}
    for d, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            if len(line) >= min_chars:
                places.setdefault(line, []).append((d, k))
    distinct = sorted(places, key=lambda line: places[line][0])
    gone = {b for i, b in enumerate(distinct) for a in distinct[:i]
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits}
    answer = {d: [] for d, _ in rows}
    for line, where in places.items():
        for d, k in where if line in gone else where[1:]:
            answer[d].append(k)
    return {d: sorted(ks) for d, ks in answer.items()}


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_against_brute_force(spark, edits):
    rng = random.Random(10 + edits)
    base = [sentence(rng, rng.randint(5, 12), 60) for _ in range(12)]
    rows = []
    for d in range(25):
        own = [changed(rng, rng.choice(base), rng.randint(0, edits + 1)) for _ in range(rng.randint(1, 4))]
        rows.append((d, "\n".join([*own, "", "short", "short"])))
    report = lines.line_report(documents(spark, rows), edits=edits, min_chars=20)
    got = {r["doc_id"]: r["removed"] for r in report.collect()}
    assert got == expected_lines(rows, edits, 20)


def test_line_edges(spark):
    line = "a line that is long enough to be looked at"
    rows = [(1, f"{line}\nkept"), (2, line), (3, None), (4, ""), (5, f"x\n{line[:-1]}\n{line}"), (6, line * 300),
            (7, line * 300 + "!"), (2, line), (None, f"{line}\nfirst of all")]
    docs = documents(spark, rows).withColumn("_row", F.lit(5)).withColumn("removed", F.lit("x"))
    got = rows_of(lines.line_report(docs), "doc_id", "n_lines", "removed")
    assert got == sorted([(1, 2, [0]), (2, 1, [0]), (2, 1, [0]), (3, 0, []), (4, 1, []), (5, 3, [1, 2]), (6, 1, []),
                          (7, 1, [0]), (None, 2, [])], key=repr)
    left = lines.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id", "text", "removed") == sorted([
        (1, "kept", "x"), (3, None, "x"), (4, "", "x"), (5, "x", "x"), (6, line * 300, "x"),
        (None, f"{line}\nfirst of all", "x")], key=repr)
    assert lines.line_report(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        lines.line_report(docs, edits=4, min_chars=20)


def test_short_lines(spark):
    """Equal lines go whatever their length, blank ones stay, segments serve from 9 characters."""
    rng = random.Random(8)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randint(1, 13))) for _ in range(25)]
    rows = [(d, "\n".join([*(changed(rng, rng.choice(base), rng.randint(0, 3)) for _ in range(6)), "", " \t", "ok"]))
            for d in range(25)]
    places = {}
    for d, text in rows:
        for k, line in enumerate(text.split("\n")):
            if line.strip():
                places.setdefault(line, []).append((d, k))
    long = [line for line in places if len(line) >= 9]
    gone = {b for b in long for a in long if places[a][0] < places[b][0] and distance(a, b) <= 2}
    want = {d: sorted(k for line, where in places.items() for e, k in (where if line in gone else where[1:]) if e == d)
            for d, _ in rows}
    assert gone and sum(map(len, want.values())) > 50
    assert {r["doc_id"]: r["removed"] for r in lines.line_report(documents(spark, rows)).collect()} == want


def test_lines_use_no_python(spark):
    plan = queries.queries()["op3_line_dedup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def words_of(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]


def shingles(text, k):
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def expected_components(rows, k, percent):
    sets = [(d, shingles(t, k)) for d, t in rows if d is not None]
    joined = Sets({d for d, _ in sets})
    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                joined.join(d, e)
    return joined


def variants(rng, base, n, most):
    for _ in range(n):
        words = base.split(" ")
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
@pytest.mark.parametrize("block", [1024, 5])
def test_documents_against_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(minhash, "SET_BLOCK", block)
    monkeypatch.setattr(minhash, "SIGNATURE_BLOCK", 4 * block)
    rng = random.Random(k)
    rows = []
    for _ in range(8):
        base = sentence(rng, rng.randint(60, 200))
        rows += [(0, v) for v in variants(rng, base, rng.randint(2, 9), 5)]
    rows += [(0, sentence(rng, n)) for n in (0, 1, 2, 2, 3, 4, 5, 6, 3000)]
    rows += [(0, v) for v in variants(rng, sentence(rng, 300), 40, 12)]
    rng.shuffle(rows)
    rows = [(d * 3, t) for d, (_, t) in enumerate(rows)]
    want = expected_components(rows, k, percent)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(
        documents(spark, rows), words=k, percent=percent).collect()}
    for d, text in rows:
        assert got[d]["n_shingles"] == len(shingles(text, k))
        assert got[d]["component_id"] == want.find(d)
        assert got[d]["kept"] == (want.find(d) == d)


def test_document_edges(spark):
    text = "The quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(5, text), (3, text.upper()), (3, text), (9, text.replace(" ", "\x0b\t")), (1, None), (2, ""), (4, " \n "),
            (6, "one"), (7, "ONE"), (8, "one two"), (None, text)]
    docs = documents(spark, rows).withColumn("bands", F.lit(1)).withColumn("component_id", F.lit("x"))
    got = rows_of(minhash.near_duplicates(docs, words=3, percent=85), "doc_id", "component_id", "kept")
    assert got == sorted([(5, 3, False), (3, 3, True), (3, 3, True), (9, 3, False), (1, 1, True), (2, 2, True),
                          (4, 4, True), (6, 6, True), (7, 6, False), (8, 8, True), (None, None, True)], key=repr)
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(5)
    functions = minhash._functions(256)
    with np.errstate(over="ignore"):
        for share in (0.3, 0.6, 0.9):
            common = rng.integers(0, 1 << 63, int(2000 * share)).astype(np.uint64)
            a, b = (np.concatenate((common, rng.integers(0, 1 << 63, int(1000 * (1 - share))).astype(np.uint64)))
                    for _ in range(2))
            signatures = [np.frombuffer(minhash._packed(minhash.minima(x, functions)), dtype="<u8") for x in (a, b)]
            agree = 1 - int(minhash.differing(*signatures)) / 256
            estimate = (agree - 1 / 16) / (1 - 1 / 16)
            assert abs(estimate - len(common) / len(np.union1d(a, b))) < 0.12


def vector_rows(rng, n, dim=16):
    rows, centres = [], rng.normal(size=(6, dim))
    for k in range(n):
        vector = centres[rng.integers(6)] + rng.normal(size=dim) * rng.choice([0.05, 0.15, 0.3, 2.0])
        rows.append((k * 2, [float(np.float32(x)) for x in vector], int(rng.integers(3))))
    rows += [(1001, rows[0][1], rows[0][2]), (1003, rows[0][1], rows[0][2]), (1005, None, 0), (1007, [0.0] * dim, 0),
             (1009, [float("nan")] * dim, 0), (1011, [None, *rows[0][1][1:]], rows[0][2]),
             (1013, [float("inf")] * dim, 0), (1015, rows[0][1], None), (1017, rows[0][1][:5], rows[0][2]),
             (1019, [2 * x for x in rows[0][1]], rows[0][2])]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


def direction(vector):
    if vector is None or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
        return None
    vector = np.asarray(vector, dtype=float)
    return vector / np.sqrt(vector @ vector)


@pytest.mark.parametrize("block", [1024, 6])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup_vectors, "BLOCK", block)
    rows = vector_rows(np.random.default_rng(6), 150)
    unit = {v: (direction(e), label) for v, e, label in rows}
    want, links = Sets(unit), dict.fromkeys(unit, 0)
    for v, (a, one) in unit.items():
        for w, (b, two) in unit.items():
            if v < w and one is not None and one == two and a is not None and b is not None and len(a) == len(b):
                if a @ b >= 0.93:
                    want.join(v, w)
                    links[v] += 1
                    links[w] += 1
    docs = spark.createDataFrame(rows, VECTORS).withColumn("bucket", F.lit("x"))
    got = rows_of(neardup_vectors.near_duplicate_vectors(docs), "vec_id", "n_links", "component_id", "kept")
    assert sum(links.values()) > 100
    assert got == sorted(((v, links[v], want.find(v), want.find(v) == v) for v in unit), key=repr)
    assert neardup_vectors.near_duplicate_vectors(docs.limit(0)).collect() == []
    assert rows_of(neardup_vectors.near_duplicate_vectors(
        spark.createDataFrame([(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)], VECTORS)),
        "vec_id", "n_links", "component_id", "kept") == [(4, 0, 4, True), (None, 0, None, True)]


def pairs_of_cosine(draw, n, dim, cosine):
    one, other = draw.standard_normal((2, n, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (one * other).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return one, cosine * one + np.sqrt(1 - cosine * cosine) * other


@pytest.mark.parametrize("dim, least, n", [(2, 0.93, 4000), (64, 0.93, 20000), (64, 0.8, 4000), (768, 0.93, 500)])
def test_pairs_at_the_threshold_meet(dim, least, n):
    one, other = pairs_of_cosine(np.random.default_rng(dim), n, dim, least + 1e-4)
    tables = neardup_vectors.tables_for(dim, least)
    a, b = neardup_vectors.buckets(one, tables), neardup_vectors.buckets(other, tables)
    met = np.zeros(n, dtype=bool)
    for k in range(a.shape[1]):
        met |= (b == a[:, k:k + 1]).any(axis=1)
    assert met.all()


def test_more_tables_for_lower_thresholds_and_fewer_misses():
    count = neardup_vectors.tables_for
    assert count(64, 0.8) > count(64, 0.93) > count(64, 0.99) >= 1
    assert count(64, 0.93, miss=1e-9) > count(64, 0.93) > count(64, 0.93, miss=0.01)
    assert count(768, 0.93) > count(64, 0.93)
    assert count(1, 1.0) >= 1
    with pytest.raises(ValueError):
        count(64, 0.0)


@pytest.mark.parametrize("least", [0.8, 0.6])
def test_vectors_of_lower_thresholds_against_brute_force(spark, least):
    one, other = pairs_of_cosine(np.random.default_rng(3), 60, 16, least + 1e-3)
    vectors = np.concatenate((one, other))
    cosines = vectors @ vectors.T
    np.fill_diagonal(cosines, 0)
    want = Sets(range(len(vectors)))
    for v, w in np.argwhere(np.triu(cosines >= least)).tolist():
        want.join(v, w)
    docs = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(vectors)], VECTORS)
    got = rows_of(neardup_vectors.near_duplicate_vectors(docs, least=least), "vec_id", "n_links", "component_id")
    links = (cosines >= least).sum(axis=1)
    assert got == sorted(((k, int(links[k]), want.find(k)) for k in range(len(vectors))), key=repr)


def test_hadamard_keeps_lengths_and_angles():
    rows = np.random.default_rng(8).normal(size=(5, 32))
    turned = neardup_vectors._hadamard(rows)
    assert np.allclose(turned @ turned.T, rows @ rows.T)


def nearest(rows, query, k):
    unit = {v: direction(e) for v, e, _ in rows}
    own = unit[query]
    found = sorted((-(own @ u), v) for v, u in unit.items() if v != query and u is not None and len(u) == len(own))
    return [v for _, v in found[:k]], [-s for s, _ in found[:k]]


@pytest.mark.parametrize("shard_rows", [40, 8192])
def test_neighbours_against_brute_force(spark, shard_rows):
    rows = vector_rows(np.random.default_rng(7), 300)
    vectors = spark.createDataFrame(rows, VECTORS).withColumn("shard", F.lit("x"))
    index = neighbours.build_index(vectors, shard_rows=shard_rows, ids_per_vector=6)
    found = neighbours.search(index, vectors.where("vec_id % 10 in (0, 1, 5, 7)"), 5, query_block=20).collect()
    got = {}
    for row in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    hits = total = 0
    for v, e, _ in rows:
        if v % 10 not in (0, 1, 5, 7) or direction(e) is None:
            assert v not in got
            continue
        want, scores = nearest(rows, v, 5)
        hits += len(set(want) & {w for w, _ in got.get(v, [])})
        total += len(want)
        assert [r for r in got.get(v, [])] == sorted(got.get(v, []), key=lambda r: (-r[1], r[0]))
    assert hits >= 0.98 * total
    empty = vectors.limit(0)
    assert neighbours.search(neighbours.build_index(empty, ids_per_vector=6), empty, 5).collect() == []


def test_every_vector_is_reached():
    rng = np.random.default_rng(9)
    vectors = np.concatenate((rng.normal(size=(300, 8)), rng.normal(size=8) + 1e-3 * rng.normal(size=(200, 8))))
    graph = neighbours.build(vectors)
    seen, todo = {graph.entry}, [graph.entry]
    while todo:
        for node in graph.edges[todo.pop()]:
            if node >= 0 and node not in seen:
                seen.add(int(node))
                todo.append(int(node))
    assert len(seen) == len(vectors)


def test_op6_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"], 0) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = {}
    for row in queries.queries()["op6_pruned_graph_search"](spark, folder).collect():
        found.setdefault(row["query_id"], {})[row["vec_id"]] = row["score"]
    hits = total = 0
    for v in (v for v, _, _ in rows if v % 50 == 0):
        want, scores = nearest(rows, v, 5)
        total += 5
        hits += len(set(want) & set(found[v]))
        for w, s in zip(want, scores):
            assert w not in found[v] or abs(found[v][w] - s) < 1e-12
    assert hits >= 0.95 * total


def test_a_bucket_of_thousands_of_near_lines(spark):
    """Lines that share all but a number: equal ends do not count, so their distance is that of
    the numbers."""
    rng = random.Random(12)
    numbers = [f"{rng.randrange(10 ** 7):07d}" for _ in range(300)] + [f"{k:04d}" for k in range(500)]
    numbers = list(dict.fromkeys(numbers))
    rng.shuffle(numbers)
    begin, end = "Every page ends with one line like this, number ", " of a very long report."
    rows = [(k, f"{begin}{number}{end}\n{begin}{number}{end}") for k, number in enumerate(numbers)]
    gone = {b: any(abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2 for a in numbers[:k]) for k, b in enumerate(numbers)}
    want = {k: [0, 1] if gone[number] else [1] for k, number in enumerate(numbers)}
    assert 50 < sum(gone.values()) < len(numbers) - 50
    assert {r["doc_id"]: r["removed"] for r in lines.line_report(documents(spark, rows)).collect()} == want
