"""Languages, mixtures, pages and the pipeline."""

import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from civicloom.llm import html, language, mixing, queries
from civicloom.session import pin
from tests.llm.small import documents, rows_of, sentence
from tests.llm.test_near import expected_components, words_of
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert len([name for name in names if name.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twins(spark, name):
    assert compare(queries.queries()[name](spark, SMALL), connect(SMALL), queries.oracle_sql()[name]) == []


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.queries()["op10_language_id"](spark, folder).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and 100 < len(held) < 400
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixtures_are_found(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    learned = language.learn(docs)
    long = {r["lang"]: r["text"] for r in docs.where("n_chars > 1500").collect()}
    mixed = documents(spark, [(1, long["fr"][:1400] + " " + long["de"][:600]), (2, long["es"][:1000])])
    rows = {r["doc_id"]: r for r in language.identify(mixed, learned).collect()}
    assert rows[1]["lang_pred"] == "fr" and sorted(rows[1]["languages"]) == ["de", "fr"]
    assert 0.55 < rows[1]["score"] < 0.85
    assert rows[2]["languages"] == ["es"] and rows[2]["score"] == 1.0


def test_all_four_languages_of_a_text_are_found(spark):
    """Equal parts, against a plain search over all sets of languages."""
    import itertools
    import math

    import numpy as np

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ["de", "en", "es", "fr"]
    parts = {lang: " ".join(r["text"] for r in docs.where(f"lang = '{lang}'").orderBy("doc_id").limit(6).collect())[:3000]
             for lang in names}
    learned = language.learn(docs)
    texts = [" ".join(parts[lang] for lang in chosen) for n in (1, 2, 3, 4) for chosen in itertools.combinations(names, n)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in language.identify(df, learned).collect()}
    assert sorted(found[len(texts) - 1]["languages"]) == names
    for k, text in enumerate(texts):
        import pyarrow as pa

        _, _, _, code, count = next(iter(language.gram_counts(pa.array([text]))))
        likelihood = learned.likelihood[code].astype(float)
        charge = language.CHARGE * 0.5 * math.log(max(count.sum(), 2))

        def fitted(chosen):
            shares = np.full(len(chosen), 1 / len(chosen))
            for _ in range(60):
                joint = shares * likelihood[:, chosen]
                joint *= (count / joint.sum(axis=1))[:, None]
                shares = joint.sum(axis=0) / count.sum()
            return (count * np.log((shares * likelihood[:, chosen]).sum(axis=1))).sum() - charge * len(chosen)

        sets = [list(c) for n in (1, 2, 3, 4) for c in itertools.combinations(range(4), n)]
        best = max(sets, key=fitted)
        assert sorted(found[k]["languages"]) == [learned.names[j] for j in best]


def test_language_edges(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "123 !?", "en", "a"), (4, "the and of the", "en", "a"),
            (4, "the and of the", "en", "a"), (None, "der und die und", "de", "a"), (6, "und der die", "de", None),
            (7, "die " * 20_000, None, "a"), (8, "日", None, None), (9, "a", None, None)]
    docs = documents(spark, rows).withColumn("score", F.lit("x"))
    learned = language.learn(docs)
    assert learned.names == ["de", "en"]
    found = language.identify(docs, learned)
    assert [c for c in found.columns if c == "score"] == ["score"]
    got = {(r["doc_id"], r["text"] is None): r["lang_pred"] for r in found.collect()}
    assert [got[1, True], got[2, False], got[3, False]] == ["und"] * 3
    assert got[4, False] == "en" and got[None, False] == got[6, False] == got[7, False] == "de"
    assert got[8, False] in learned.names and got[9, False] in learned.names
    nothing = language.learn(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), learned).collect() == []


def filled(sizes, weights, most):
    """Targets by filling up source after source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, rest = {}, float(sum(sizes.values()))
    while True:
        level = rest / sum(weight[s] for s in names if s not in full) if len(full) < len(names) else 0
        over = [s for s in names if s not in full and weight[s] * level > most * sizes[s] + 1e-9]
        if not over:
            return {s: full.get(s, weight[s] * level) for s in names}
        for s in over:
            full[s] = most * sizes[s]
            rest -= full[s]


def test_targets(spark):
    rng = random.Random(3)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{k}": rng.choice([0, 1, 5, 50, 5000]) for k in range(n)} | {None: 7, "Ä": 3, "z": 11}
        df = spark.createDataFrame([(s, k) for s, k in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df, (5.0, 2.0, 1.0), 3.0).collect()}
        assert got == pytest.approx(filled(sizes, (5.0, 2.0, 1.0), 3.0))


@pytest.mark.parametrize("group_rows", [512, 4])
def test_mixture(spark, monkeypatch, group_rows):
    monkeypatch.setattr(mixing, "GROUP_ROWS", group_rows)
    rng = random.Random(4)
    rows = [(k, sentence(rng, rng.randint(0, 60)), "en", rng.choice(["a", "a", "a", "b", "c", None])) for k in range(400)]
    docs = documents(spark, rows).withColumn("size", F.lit("x"))
    got = mixing.mixture(docs, (5.0, 2.0, 1.0), 3.0, 1).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(400))
    sizes, largest, taken = {}, {}, {}
    for r in got:
        assert r["size"] == len(words_of(rows[r["doc_id"]][1]))
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 3 * r["size"]
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        largest[s] = max(largest.get(s, 0), r["size"])
        taken[s] = taken.get(s, 0) + r["taken"]
    want = filled(sizes, (5.0, 2.0, 1.0), 3.0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    again = mixing.mixture(docs.repartition(7), (5.0, 2.0, 1.0), 3.0, 1)
    assert rows_of(again, "doc_id", "taken") == sorted(((r["doc_id"], r["taken"]) for r in got), key=repr)
    other = mixing.mixture(docs, (5.0, 2.0, 1.0), 3.0, 2)
    assert rows_of(other, "doc_id", "taken") != rows_of(again, "doc_id", "taken")


def test_expectations_hold(spark):
    """Over many seeds a document is taken as often as its source's share says."""
    rows = [(k, "w " * (1 + k % 9), "en", "ab"[k % 2]) for k in range(40)]
    docs = documents(spark, rows)
    total = {}
    for seed in range(12):
        for r in mixing.mixture(docs, (5.0, 2.0, 1.0), 3.0, seed).collect():
            total[r["source"]] = total.get(r["source"], 0) + r["copies"] / (r["target"] / r["source_size"])
    for mean in total.values():
        assert abs(mean / 12 / 20 - 1) < 0.1


def test_mixing_edges(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "x " * 50_000, "en", "a"), (4, "one two", "en", "b")]
    rows += [(5, "again and again", "en", "b")] * 7 + [(None, "no id", "en", "b")]
    docs = documents(spark, rows).withColumn("_key", F.lit(1)).withColumn("copies", F.lit("x"))
    got = mixing.mixture(docs, (5.0, 2.0, 1.0), 3.0, 1)
    assert got.count() == len(rows) and got.where("taken > 3 * size").count() == 0
    mixed = mixing.mix(docs, (5.0, 2.0, 1.0), 3.0, 1)
    assert mixed.columns == docs.columns
    assert sorted(r["doc_id"] for r in mixed.where("doc_id < 3").collect()) == [1, 2]
    want = got.agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == want
    assert mixing.mixture(docs.limit(0), (5.0, 2.0), 3.0, 1).collect() == []
    assert mixing.mix(docs.limit(0), (5.0, 2.0), 3.0, 1).collect() == []


def test_mixing_uses_no_python(spark):
    plan = queries.queries()["op5_mixing"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
<nav><ul><li><a href="/x">Home</a></li></ul></nav><!-- <p>gone</p> -->%s<aside>More</aside>
<form><label>Mail</label><input></form><section id="comments"><p>I liked this very much indeed, thank you.</p></section>
<footer>&copy; site</footer></body></html>"""


def test_pages():
    article = "<article><h1>Head &amp; line</h1><p>One <b>bold</b>er\n word.<br>Two&nbsp;&#233;.<p>Un.<div class=ad>buy</div></article>"
    assert html.main_text(PAGE % article) == "Head & line One bolder word. Two é. Un."
    body = "<div class='story'>" + "".join(f"<p>Paragraph {k} has some words in it.</p>" for k in range(5)) + "</div>"
    assert html.main_text(PAGE % body) == " ".join(f"Paragraph {k} has some words in it." for k in range(5))


def test_page_edges(spark):
    deep = "<div>" * 5000 + "deep"
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain text &lt;b&gt;"), (4, "u", "<p>cut <a href='x"),
            (5, "u", "<nav>only menus</nav>"), (6, "u", "<article><p>a</article>" * 2), (7, "u", deep),
            (8, "u", "<p>" + "long " * 100_000), (8, "u", "<p>x"), (None, "u", "<p x='>'>y</p a < b"),
            (9, "u", "<article><script>never closed <p>text"), (10, "u", "<article>t <img alt=\"a>b\"> u</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = html.extract_main_text(pages)
    assert found.columns == ["page_id", "url", "text"]
    got = sorted(((r["page_id"], r["text"]) for r in found.collect()), key=repr)
    assert got == sorted([(1, ""), (2, ""), (3, "plain text <b>"), (4, "cut"), (5, ""), (6, "a a"), (7, "deep"),
                          (8, ("long " * 100_000).strip()), (8, "x"), (None, "y"), (9, ""), (10, "t u")], key=repr)
    assert html.extract_main_text(pages.limit(0)).collect() == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs
        docs = pin(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == names or name == "packing"
    assert kept["lines"].count() == kept["language"].count()  # all have a language
    rows = [(r["doc_id"], r["text"]) for r in kept["near_copies"].collect()]
    want = expected_components(rows, 5, 80)
    assert rows_of(kept["mixture"], "doc_id") == sorted(((d,) for d, _ in rows if want.find(d) == d), key=repr)
    assert docs.count() >= kept["packing"].count() > 0


def test_pipeline_edges(spark):
    text = "The quick brown fox jumps over the lazy dog near the river bank today\nand then it sleeps for hours"
    rows = [(1, None), (2, ""), (3, "123"), (4, text), (4, text), (5, text), (None, "the dog and the fox")]
    docs = documents(spark, rows).withColumn("score", F.lit(1)).withColumn("_row", F.lit(2)).withColumn(
        "component_id", F.lit("x"))
    for empty in (False, True):
        left = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = pin(stage(spark, left, SMALL), f"test-{name}")
            assert left.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, left, SMALL)
        assert {r["doc_id"] for r in packed.collect()} <= (set() if empty else {4, None})


def blocks(*texts):
    return "".join(f"<p>{text}</p>" for text in texts)


def test_pages_of_unequal_paragraphs():
    """Neither a huge paragraph nor a short one at the ends takes other paragraphs away."""
    few = [f"{k} " + "word " * 40 for k in range(15)]
    texts = ["Short.", "By X.", *few, "huge " * 2000, *few, "The", "end", "is", "here."]
    joined = " ".join(" ".join(t.split()) for t in texts)
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Menu entry {k}</a></li>" for k in range(20)) + "</ul>"
    assert html.main_text(PAGE % f"<div>{blocks(*texts)}</div>") == joined
    assert html.main_text(f"<body>{menu}<div>{blocks(*texts)}</div>{menu}</body>") == joined
    poem = [f"a line of a poem {k}" for k in range(100)]
    page = f"<body><div>{blocks(*poem)}</div><nav>x</nav><p>{'far ' * 30}</p></body>"
    assert " ".join(poem) in html.main_text(page)


def test_windows_hold_three_lines_of_text():
    lines = html.page_lines("<div><div><p>a</p></div></div><nav>n<div>m</div></nav><ul><li>b</li><li>c</li></ul>")
    assert [line.text for line in lines] == ["a", "", "b", "c"]


def test_marks_check_what_the_windows_pick():
    story = [f"Paragraph {k} of the story has a fair number of words in it, as stories do." for k in range(6)]
    text = " ".join(["Head", *story, "Fin."])
    body = f"<h1>Head</h1>{blocks(*story)}<p>Fin.</p>"
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Entry {k}</a></li>" for k in range(9)) + "</ul>"
    card = "<article class=card><h3>Next</h3><p>A teaser of another story, with a few words.</p></article>"
    assert html.main_text(f"<body>{menu}<div>{body}</div>{menu}</body>") == text  # unmarked
    for page in (f"<div>{body}</div>{card}", f"{card}<div>{body}</div>", f"{card}{menu}<div>{body}</div>{menu}{card}"):
        assert html.main_text(f"<body>{page}</body>") == text
        assert html.main_text(f"<body><main>{page}</main></body>") == text
    wrapped = f"<body><main>{menu}<div>Site</div>{menu}<div>{body}</div>{menu}<div>&copy; 2020</div></main></body>"
    assert html.main_text(wrapped) == text
    marked = f"<body><p>Of today</p><article>{body[:-11]}<div class=ad>Buy</div><p>Fin.</p></article><p>Legal</p></body>"
    assert html.main_text(marked) == text
    assert html.main_text("<article><p>a</p></article><article><p>b</p></article>") == "a b"


def test_windows_decide_on_marked_pages():
    lines = html.page_lines("<article><ul>" + "<li><a>Entry</a></li>" * 9 + f"</ul><p>{'word ' * 50}</p></article>")
    assert html.between_surge_and_dive(lines) == (9, 10)


def test_classes_of_wrappers_do_not_drop_the_article():
    story = [f"{k} " + "word " * 40 for k in range(6)]
    text = " ".join(" ".join(t.split()) for t in story)
    foot = "<footer>&copy; site</footer><p class=copyright><a href=/>Site</a></p>"
    for wrapper in ("<div class='content no-sidebar'>", "<div class='elementor-widget-text-editor'>",
                    "<div id='page' class='site has-header'>", "<div class='layout sidebar-right'><div class='widget'>"):
        body = f"{wrapper}{blocks(*story)}<div class='promo'>Buy <b>now</b></div></div></div>"
        assert html.main_text(f"<body>{body}{foot}</body>") == text, wrapper
    # What holds most of the text, but none of an article's, is furniture all the same.
    page = f"<body><article><p>A short note.</p></article><div class='sidebar'>{blocks(*story)}</div></body>"
    assert html.main_text(page) == "A short note."
    page = f"<body><div><p>{'word ' * 30}</p></div><div class='comments'>{blocks(*story)}</div></body>"
    assert html.main_text(page) == ("word " * 30).strip()


def test_an_element_that_closes_itself_drops_nothing():
    assert html.main_text("<article><p>before <svg/> after</p><p>next <svg><path/><text>x</text></svg> end</p></article>") == \
        "before after next end"


def test_unmatched_tags_take_time_by_the_length_of_the_page():
    for unit in ("<b>x</i>", "<p>x</div>", "<a>x", "<div class=ad>x</p>"):
        began = time.process_time()
        html.main_text(unit * 20_000)
        assert time.process_time() - began < 4, unit
