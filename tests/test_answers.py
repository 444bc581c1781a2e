"""Answers for a batch that asks A, B and 7."""

import json
import random

import pytest
from pyspark.sql import functions as F

from civicloom.functions.labels import label_description
from civicloom.operators.annotate import annotate, match_answers, parse_answers
from civicloom.operators.join import merge_labels_upsert

GOOD = '[{"id":"A","label":1},{"id":"B","label":"2"},{"id":7,"label":0}]'
CASES = [
    (GOOD, "1 2 0"),
    (f"Here:\n```json\n{GOOD}\n```", "1 2 0"),
    (f"```\n{GOOD}\n``` that is all", "1 2 0"),
    ('[{"id":"A","label":9},{"id":"B","label":1.0},{"id":7,"label":true}]', "254 254 254"),
    ('[{"id":"A","label":null},{"id":"B"},5,"x"]', "254 253 253"),
    ('[{"id":"A","label":0},{"id":"A","label":2}]', "2 253 253"),
    ('[{"id":"A","label":2},{"id":"A","label":8}]', "254 253 253"),
    ("[]", "253 253 253"),
    ('{"id":"A","label":1}', "253 253 253"),
    ('"s"', "253 253 253"),
    ("5", "255 255 255"),
    ("null", "255 255 255"),
    ("true", "255 255 255"),
    ("not json", "253 253 253"),
    ("[1] extra", "253 253 253"),
    ('[{"id":"A","label":1},', "253 253 253"),
    ("", "253 253 253"),
    ('[{"id":"A","label":1}],"b":2', "253 253 253"),
    ('[{"id":"A","label":1}],[2]', "253 253 253"),
    ('[{"id":"A","label":1}]} {"z":1', "253 253 253"),
    ('[{"id":"A","id":"B","label":1,"label":2}]', "253 2 253"),
    (None, "255 255 255"),
]


def answered(spark, answers):
    members = [(1, "A"), (2, "B"), (3, "7")]
    return spark.createDataFrame(
        [(i, members, answer, None) for i, answer in enumerate(answers)],
        "batch_num bigint, members array<struct<pos int, ticket_id string>>, "
        "answer string, error string",
    )


def codes(df):
    found = {}
    for row in df.orderBy("batch_num", "pos").collect():
        found.setdefault(row["batch_num"], []).append(row["code"])
    return [" ".join(found[i]) for i in sorted(found)]


def test_cases(spark):
    got = codes(match_answers(answered(spark, [answer for answer, _ in CASES]), error_col="error"))
    assert got == [expected for _, expected in CASES]


def test_reasons(spark):
    answers = ['[{"id":"A","label":1,"reasoning":"why"},{"id":"B","label":2},{"id":7,"label":5}]', "x", "[]", "1"]
    rows = match_answers(answered(spark, answers)).orderBy("batch_num", "pos").collect()
    assert [row["reasoning"] for row in rows[:3]] == ["why", "", "Invalid label returned by LLM"]
    assert {row["reasoning"] for row in rows[3:6]} == {"Failed to parse JSON response"}
    assert {row["reasoning"] for row in rows[6:9]} == {"Missing result in JSON response"}
    assert rows[9]["reasoning"].startswith("API error: ")


def by_hand(answer):
    try:
        value = json.loads(answer)
    except ValueError:
        return "253 253 253"
    if value is None or isinstance(value, (bool, int, float)):
        return "255 255 255"
    known = {}
    for entry in value:
        if isinstance(entry, dict) and "id" in entry and "label" in entry:
            label = str(entry["label"])
            known[str(entry["id"])] = label if label in ("0", "1", "2") else "254"
    return " ".join(known.get(name, "253") for name in ("A", "B", "7"))


def test_random_answers_against_plain_python(spark):
    rng = random.Random(11)
    ids = ["A", "B", 7, "7", 7.0, None, True, [1]]
    labels = [0, 1, 2, "0", "1", "2", 3, "x", 1.0, True, None, [], {"a": 1}, -0, 10**30]

    def entry():
        pick = rng.random()
        if pick < 0.1:
            return rng.choice([5, "x", None, [], {"id": "A"}, {"label": 1}])
        return {"id": rng.choice(ids), "label": rng.choice(labels), "reasoning": rng.choice(["r", None, 3])}

    answers = []
    for _ in range(800):
        text = json.dumps([entry() for _ in range(rng.randint(0, 6))])
        pick = rng.random()
        answers.append(text if pick < 0.8 else text[:-1] if pick < 0.9 else text + rng.choice([" x", "]", ",1", "{}"]))
    got = codes(match_answers(answered(spark, answers)))
    assert got == [by_hand(answer) for answer in answers]


def test_parse_answers_keeps_the_last(spark):
    rows = parse_answers(answered(spark, ['[{"id":"A","label":0},{"id":"A","label":2}]', "x"])).collect()
    assert [(row["batch_num"], row["id"], row["code"]) for row in rows] == [(0, "A", "2")]


def test_label_description(spark):
    rows = spark.createDataFrame([("0",), ("255",), ("9",), (None,)], "code string")
    texts = [row[0] for row in rows.select(label_description(F.col("code"))).collect()]
    assert texts == ["Not Sufficient", "API Error", "Unknown", "Unknown"]


@pytest.fixture
def complaints(spark):
    rows = [(f"t{i:03d}", f"text {i}", None if i % 3 else "Sufficient", None) for i in range(90)]
    rows += [("x1", None, None, None), ("x2", "again", "API Error", "API error: old")]
    return spark.createDataFrame(
        rows, "ticket_id string, comment string, llm_label string, llm_reasoning string"
    )


def test_annotate(spark, complaints):
    def fn(request):
        ids = [line.split("Ticket ID: ")[1].split(")")[0] for line in request.splitlines() if "Ticket ID" in line]
        if "t010" in ids:
            raise RuntimeError("busy")
        return json.dumps([{"id": name, "label": 0, "reasoning": f"of {len(ids)}"} for name in ids])

    labels = annotate(complaints, fn, ["ticket_id"], batch_size=7, parallelism=3)
    rows = {row["ticket_id"]: row for row in labels.collect()}
    assert "x1" not in rows and len(rows) == 91
    assert rows["t000"]["llm_label"] == "Sufficient" and rows["t000"]["batch_num"] == 0
    assert rows["t010"]["llm_label"] == "API Error"
    assert rows["t010"]["llm_reasoning"] == "API error: busy"
    failed = [name for name, row in rows.items() if row["llm_label"] == "API Error"]
    assert len(failed) == 7
    assert rows["x2"]["llm_label"] == "Not Sufficient"
    merged = merge_labels_upsert(complaints, labels, ["batch_num", "pos"])
    assert merged.count() == complaints.count()
    assert merged.filter("ticket_id = 'x1'").first()["llm_label"] is None
