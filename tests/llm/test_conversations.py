"""Conversation repair, the prefix trie and exact top-k search, against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from civicloom.llm import queries, repair, topk, trie
from tests.llm.small import rows_of

CONVERSATIONS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def mark(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def in_order(rows, stand_in):
    """Turns of each conversation in order, nulls replaced."""
    found = {}
    for conv, turn, role, text in rows:
        role, text = stand_in if role is None else role, stand_in if text is None else text
        found.setdefault(conv, []).append((turn is not None, turn or 0, mark(role, text), role, text))
    return {conv: [(t if there else None, role, text) for there, t, _, role, text in sorted(turns)]
            for conv, turns in found.items()}


def cheapest(turns):
    """Least (cost, audit, lines), by trying every edit from every state."""
    states = {"": (0, "", ())}  # by the roles' initials that matter: '', 's', 'u', 'a'

    def inserted(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                due = "a" if state == "u" else "u"
                way = (cost + 2, audit + "I", lines + (({"u": "user", "a": "assistant"}[due], ""),))
                states[due] = min(states.get(due, way), way)
        return states

    seen = set()
    for _, role, text in turns:
        visible = text.strip(BLANKS)
        must_go = not visible or (role, text) in seen
        extra = int(bool(visible) and not must_go and visible[-1] not in ".!?")
        seen.add((role, text))
        after = {}
        for state, (cost, audit, lines) in inserted(states).items():
            ways = [(state, (cost + 3, audit + "D", lines))]
            if not must_go:
                due = "a" if state == "u" else "u"
                name = {"u": "user", "a": "assistant"}[due]
                ways.append((due, (cost + 2 + extra, audit + "R", lines + ((name, text),))))
                if role[:1] == due or (role[:1] == "s" and state == ""):
                    ways.append((role[0], (cost + extra, audit + "K", lines + ((role, text),))))
            for end, way in ways:
                after[end] = min(after.get(end, way), way)
        states = after
    ended = inserted(states)
    return min(ended[state] for state in ("", "a") if state in ended)


def expected_repair(rows):
    answer = {}
    for conv, turns in in_order(rows, " ").items():
        cost, audit, lines = cheapest(turns)
        seen, counts = set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            visible = text.strip(BLANKS)
            if not visible:
                counts["blank"] += 1
            elif (role, text) in seen:
                counts["duplicate"] += 1
            elif visible[-1] not in ".!?":
                counts["truncated"] += 1
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        text = "\n".join(f"{role}:{text}" for role, text in lines)
        answer[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return answer


REPAIRED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def random_turns(rng, convs, longest=9):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Usher"])
            text = rng.choice(["Yes.", "No", "And?", "", " \t", "Why not!", "é", "Yes. ", "a.\n", None, f"t{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None, turn // 2]), role, text))
    return rows


@pytest.mark.parametrize("segment", [1, 3, 2048])
def test_repair_equals_every_way_tried(spark, segment):
    rng = random.Random(segment)
    rows = random_turns(rng, 150) + [(None, 1, "user", "Hi."), (None, 2, "user", "Hi."), (500, None, None, None)]
    rows += [(900, k, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", f"{k}!"])) for k in range(40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("_n", F.lit(1)).withColumn("number", F.lit("x"))
    found = repair.digest_repaired(df, repair.audit(df, segment=segment))
    got = {row["conv_id"]: tuple(row[name] for name in REPAIRED) for row in found.collect()}
    want = expected_repair(rows)
    assert {k: v for k, v in got.items() if v != want[k]} == {} and set(got) == set(want)


def test_long_conversation_by_segments(spark):
    rng = random.Random(8)
    rows = [(1, k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"{k}.", f"{k}", "", "Again."]))
            for k in range(7000)]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    whole, cut = (rows_of(repair.audit(df, segment=n)) for n in (10_000, 100))
    assert whole == cut and len(whole[0][-1]) >= 7000


def test_equal_pasts_are_one_node_though_all_hashes_collide(monkeypatch):
    rng = random.Random(5)
    kinds = [rng.randrange(16) for _ in range(60)]
    plain = repair.segment_paths(kinds, False)
    monkeypatch.setattr(repair, "_MODULUS", 1)
    assert repair.segment_paths(kinds, False) == plain


def test_order_of_trails():
    rng = random.Random(2)
    trails, nodes = repair.Trails(), {"": 0}
    for _ in range(400):
        text = rng.choice(list(nodes)) if rng.random() < 0.3 else max(nodes, key=len)
        for letter in "DKR"[:rng.randint(1, 3)]:
            nodes[text + letter] = trails.extend(nodes[text], letter.encode())
    by_depth = {}
    for text in nodes:
        by_depth.setdefault(len(text), []).append(text)
    for texts in by_depth.values():
        for a in texts[:20]:
            for b in texts[:20]:
                if a != b:
                    assert trails.before(nodes[a], nodes[b]) == (a < b)
    assert all(trails.text(node).decode() == text for text, node in nodes.items())


def test_repair_query_on_odd_rows(spark, folder):
    rows = random_turns(random.Random(9), 60) + [(None, None, None, None)]
    spark.createDataFrame(rows, CONVERSATIONS).write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([], CONVERSATIONS).write.parquet(f"{folder}/empty/conversations.parquet")
    got = {row["conv_id"]: tuple(row[name] for name in REPAIRED)
           for row in queries.queries()["op11_conversation_repair"](spark, folder).collect()}
    damaged = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        elif fault == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        elif fault == 4:
            role = "user"
        damaged += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    want = expected_repair(damaged)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {conv: want.get(conv, none) for conv, *_ in rows}
    assert queries.queries()["op11_conversation_repair"](spark, f"{folder}/empty").collect() == []


def expected_trie(rows, group, heads):
    turns = in_order([row for row in rows if row[0] is not None], "")
    whole = {}
    for conv, own in turns.items():
        taken = zlib.crc32(str(conv).encode()) % heads
        # Remainders go with the sign of the dividend.
        base = conv - (abs(conv) % group) * (1 if conv >= 0 else -1)
        whole[conv] = [(r, t) for _, r, t in turns.get(base, [])[:taken] + own[taken:]]
    members = {}
    for conv, sequence in whole.items():
        for depth in range(len(sequence) + 1):
            members.setdefault(tuple(sequence[:depth]), []).append(conv)
    answer = []
    for prefix, convs in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        children = {p for p in below if len(p) == len(prefix) + 1}
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(prefix))
        answer.append((
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), len(children),
            len(leaves), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(answer, key=repr)


@pytest.mark.parametrize("longest", [1, 2, 5, 12, 17])
def test_trie_equals_all_prefixes(spark, longest, monkeypatch):
    monkeypatch.setattr(trie, "_CHUNK", 3)
    rng = random.Random(longest)
    rows = [(None, 0, "user", "lost")]
    for conv in [*range(-3, 30), *range(400, 430)]:
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(["a", "", None, "éé"]) if rng.random() < 0.4 else "same"
            rows.append((conv, rng.choice([turn, turn, None, turn]), rng.choice(["user", "user", None]), text))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("depth", F.lit("x"))
    found = rows_of(trie.prefix_trie(trie.rebuilt(df, group=10, heads=4)))
    assert found == expected_trie(rows, 10, 4)


def test_trie_of_nothing_and_of_one_empty_conversation(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert trie.prefix_trie(trie.rebuilt(empty)).collect() == []
    # Its only turn is replaced by the head of a conversation that is not there.
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    df = spark.createDataFrame([(conv, 0, "user", "a")], CONVERSATIONS)
    ends = hashlib.sha256(str(conv).encode()).hexdigest()
    assert rows_of(trie.prefix_trie(trie.rebuilt(df))) == [(conv, 0, None, 1, 0, 1, 0, ends)]


VECTORS = "vec_id long, vector array<bigint>, dim string"


def expected_top(vectors, queries_, k):
    answer = []
    for q, query, _ in queries_:
        if q is None or query is None or None in query:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(query, v)), c) for c, v, _ in vectors
            if c is not None and c != q and v is not None and None not in v and len(v) == len(query))
        answer += [(q, rank, c, -score) for rank, (score, c) in enumerate(scored[:k], 1)]
    return sorted(answer, key=repr)


@pytest.mark.parametrize("size", [3, 1000, 2**29, 2**31])
def test_top_k_equals_sorting_all_scores(spark, size):
    rng = random.Random(size)
    rows = [(k, [rng.randint(-size, size - 1) for _ in range(2)], "x") for k in range(260)]
    rows += [(1000 + k, rows[7][1], "x") for k in range(70)]  # copies tie
    rows += [(k, [1, 2, 3], "x") for k in (2000, 2010)] + [(2020, [], "x"), (2030, [], "x")]
    rows += [(None, [1, 1], "x"), (3000, None, "x"), (3010, [None, 1], "x"), (4000, [5], "x")]
    rows += [rows[20]] * 2  # repeated rows
    rng.shuffle(rows)
    vectors = spark.createDataFrame(rows, VECTORS)
    asked = vectors.where("vec_id % 10 = 0 or vec_id is null")
    found = topk.top_k(vectors, asked, 12, query_block=16, vector_block=32)
    assert rows_of(found) == expected_top(rows, [r for r in rows if r[0] is None or r[0] % 10 == 0], 12)


def test_top_k_of_one_value_and_of_nothing(spark):
    rows = [(k, [1, -1], "x") for k in range(300)]
    vectors = spark.createDataFrame(rows, VECTORS)
    found = topk.top_k(vectors, vectors.where("vec_id in (0, 299)"), 5, vector_block=16)
    assert rows_of(found) == expected_top(rows, [rows[0], rows[299]], 5)
    assert topk.top_k(vectors, vectors.limit(0), 5).collect() == []
    assert topk.top_k(vectors.limit(0), vectors, 5).collect() == []


def test_scores_beyond_a_long_are_an_error():
    import numpy as np

    big = np.array([[2**62, 2**62]])
    with pytest.raises(OverflowError):
        list(topk.score_blocks(big, big))
