"""The operators bound to the test tables with production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.llm import (
    html,
    language,
    lines,
    minhash,
    mixing,
    neardup_vectors,
    neighbours,
    packing,
    repair,
    token_files,
    tokens,
    topk,
    trie,
)
from civicloom.queries.registry import ready
from civicloom.session import fresh_path, pin, pins, unpin

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    """Where this machine keeps the vocabulary; every executor has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(ready(spark), folder)

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


MAX_TOKENS = 1024
PACK_END = 2
FILE_END = 0


def packed(docs: DataFrame) -> DataFrame:
    encoded = tokens.encode_documents(docs, tokenizer_path(), PACK_END)
    pieces = packing.cut_pieces(encoded, MAX_TOKENS)
    lean = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(lean, MAX_TOKENS, order_by=["doc_id", "piece", "start", "length", "ids_crc32"])


def packed_sequences(docs: DataFrame) -> DataFrame:
    """The filled sequences of ``docs``, one row each."""
    spark, before = docs.sparkSession, set(pins(docs.sparkSession))
    encoded = tokens.encode_documents(docs, tokenizer_path(), PACK_END)
    cut = packing.cut_pieces(encoded, MAX_TOKENS)
    # Copies of a document agree in everything else. The numbers are written with the pieces.
    pieces = pin(cut.withColumns({"key": F.monotonically_increasing_id(), "ids_crc32": F.crc32("ids")}), "token-pieces")
    order = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # Written, so that its true size decides whether ids are shuffled to meet it.
    placed = pin(packing.pack(pieces.select("key", *order), MAX_TOKENS, order_by=order), "placed")
    filled = packing.fill_sequences(placed, pieces, key="key")
    # The sequences are read from what was pinned last.
    unpin(spark, [path for path in pins(spark)[:-1] if path not in before])
    return filled


@query("op1_best_fit_packing")
def op1(spark, folder):
    return packed(table(spark, folder, "documents").select("doc_id", "text"))


@query("op4_token_counts")
def op4(spark, folder):
    counts = tokens.count_tokens(table(spark, folder, "documents"), tokenizer_path())
    return tokens.length_histogram(counts)


@query("op9_wavelet_token_files")
def op9(spark, folder):
    docs = table(spark, folder, "documents")
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(docs, tokenizer_path(), FILE_END, path)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


MIX_WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3.0
MIX_SEED = 5


@query("op5_mixing")
def op5(spark, folder):
    docs = table(spark, folder, "documents")
    return mixing.mixture(docs, MIX_WEIGHTS, MAX_REPEATS, MIX_SEED).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


# Word shingles joined on themselves, and the smallest id reachable over confirmed links.
MINHASH_SQL = """
WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^ \\t-\\r]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n
    HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
smallest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN smallest m ON m.x = d.doc_id
"""


@query("op7_bbit_minhash", MINHASH_SQL)
def op7(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


def held_out() -> Column:
    """Documents that no classifier learns from; those without an id among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


@query("op10_language_id")
def op10(spark, folder):
    docs = table(spark, folder, "documents")
    learned = language.learn(docs.where(~held_out()))
    found = language.identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages")


LINE_EDITS = 2


@query("op3_line_dedup")
def op3(spark, folder):
    return lines.line_report(table(spark, folder, "documents"), edits=LINE_EDITS)


# The pages mark their article: its blocks, without inline markup, in page order.
HTML_SQL = r"""
WITH blocks AS (
    SELECT page_id, url, regexp_replace(
        regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'),
        '<[^>]*>', ' ', 'g') AS raw
    FROM pages),
plain AS (
    SELECT page_id, url, trim(regexp_replace(
        replace(replace(replace(replace(raw, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'),
        '\s+', ' ', 'g')) AS text
    FROM blocks)
SELECT page_id, url, text, length(text) AS n_chars FROM plain
"""


@query("op8_html_line_blocks", HTML_SQL)
def op8(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html.extract_main_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))


# All pairs of a label, and the smallest id reachable.
VECTORS_SQL = """
WITH RECURSIVE
able AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y
    FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
    SELECT vec_id AS x, vec_id AS y FROM embeddings
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
smallest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, e.label, coalesce(c.n, 0) AS n_links, s.component_id, e.vec_id = s.component_id AS kept
FROM embeddings e JOIN smallest s ON s.x = e.vec_id LEFT JOIN counts c ON c.x = e.vec_id
"""


@query("op2_cross_polytope_dedup", VECTORS_SQL)
def op2(spark, folder):
    return neardup_vectors.near_duplicate_vectors(table(spark, folder, "embeddings"), least=0.93)


NEAREST = 5


@query("op6_pruned_graph_search")
def op6(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    index = pin(neighbours.build_index(vectors, ids_per_vector=NEAREST + 1), "graphs")
    return neighbours.search(index, vectors.where("vec_id % 50 = 0"), NEAREST)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of conversation and turn; null roles and texts
    are one space."""
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(place) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times", "copy")


# CRC-32 of an ASCII text ``{0}``, eight bits of a character at a time.
_CRC_SQL = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, ch: list_reduce(list_prepend(xor(crc, ch), range(8)),
                                lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""


# Above every cost; a cheapest past is ten digits of its cost, then its initials.
_NEVER = "5" + "0" * 9


def _then(past: str, price: str, initials: str) -> str:
    return f"(lpad((substr({past}, 1, 10)::BIGINT + {price})::VARCHAR, 10, '0') || substr({past}, 11) || '{initials}')"


def _stays(past: str, initial: str) -> str:
    """A past goes on with a turn kept or made one of the role that is due."""
    return (f"CASE WHEN q.must_go THEN '{_NEVER}' WHEN q.initial = '{initial}' THEN {_then(past, 'q.extra', 'K')} "
            f"ELSE {_then(past, '2 + q.extra', 'R')} END")


# The cheapest pasts of the four states, turn after turn; the least text is the cheapest past and
# of several the first. Inserts come before a turn is dealt with (w), then its own edit.
REPAIR_SQL = rf"""
WITH RECURSIVE
source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_CRC_SQL.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
    FROM conversations),
turns AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM source),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(strlen(role)::VARCHAR || ':' || role || text)) AS n
    FROM turns),
judged AS (
    SELECT *, substr(role, 1, 1) AS initial,
           NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
           NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS unended,
           lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
    FROM placed),
ruled AS (
    SELECT *, blank OR again AS must_go, (unended AND NOT blank AND NOT again)::BIGINT AS extra FROM judged),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate,
           sum(extra)::BIGINT AS truncated,
           count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
           max(n) AS last
    FROM ruled GROUP BY conv_id),
walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS n, '{"0" * 10}' AS s0, '{_NEVER}' AS s1, '{_NEVER}' AS s2, '{_NEVER}' AS s3
    FROM ruled
    UNION ALL
    SELECT w.conv_id, q.n, {_then("w.s0", "3", "D")},
           least({_then("w.s1", "3", "D")},
                 CASE WHEN q.initial = 's' AND NOT q.must_go THEN {_then("w.s0", "q.extra", "K")} ELSE '{_NEVER}' END),
           least({_then("w.s2", "3", "D")}, {", ".join(_stays(f"w.{s}", "u") for s in ("s0", "s1", "s3"))}),
           least({_then("w.s3", "3", "D")}, {_stays("w.s2", "a")})
    FROM (SELECT conv_id, n, s0, s1, s2, least(s3, {_then("s2", "2", "I")}) AS s3
          FROM (SELECT conv_id, n, s0, s1, s3,
                       least(s2, {", ".join(_then(s, "2", "I") for s in ("s0", "s1", "s3"))}) AS s2
                FROM walk)) w
    JOIN ruled q ON q.conv_id IS NOT DISTINCT FROM w.conv_id AND q.n = w.n + 1),
best AS (
    SELECT w.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal,
           least(s0, s3, {_then("s2", "2", "I")}, {_then("s1", "4", "II")}) AS past
    FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.last = w.n),
edits AS (
    SELECT conv_id, place, substr(past, (10 + place)::BIGINT, 1) AS edit
    FROM (SELECT conv_id, past, unnest(range(1, length(past) - 9)) AS place FROM best)),
dealt AS (
    SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS n FROM edits),
lines AS (
    SELECT d.conv_id, d.place, d.edit, q.role, CASE WHEN d.edit = 'I' THEN '' ELSE q.text END AS text,
           count(*) FILTER (WHERE NOT (d.edit = 'K' AND q.initial = 's'))
               OVER (PARTITION BY d.conv_id ORDER BY d.place) AS due
    FROM dealt d LEFT JOIN ruled q ON q.conv_id IS NOT DISTINCT FROM d.conv_id AND q.n = d.n
    WHERE d.edit <> 'D'),
whole AS (
    SELECT conv_id, string_agg(
        CASE WHEN edit = 'K' THEN role WHEN due % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
        chr(10) ORDER BY place) AS repaired
    FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(b.gaps, 0) AS gaps, coalesce(b.blank, 0) AS blank, coalesce(b.duplicate, 0) AS duplicate,
       coalesce(b.truncated, 0) AS truncated, coalesce(b.illegal, 0) AS illegal,
       coalesce(substr(b.past, 1, 10)::BIGINT, 0) AS cost, coalesce(substr(b.past, 11), '') AS audit,
       sha256(coalesce(w.repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op11_conversation_repair", REPAIR_SQL)
def op11(spark, folder):
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    repaired = repair.repair(damaged(conversations))
    asked = conversations.select(F.col("conv_id").alias("asked")).distinct()
    none = F.lit(0).cast("long")
    return asked.join(repaired, F.col("asked").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("asked").alias("conv_id"),
        *[F.coalesce(name, none).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


TOP = 10

TOP_K_SQL = f"""
WITH able AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM able q JOIN able c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {TOP}
"""


def integers(embeddings: DataFrame) -> DataFrame:
    """Vectors of ``floor(1024 * x)``; null where one is null or holds a null or non-finite component."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024))
    return embeddings.select("vec_id", F.when(finite, whole).alias("vector"))


@query("op12_exact_top_k", TOP_K_SQL)
def op12(spark, folder):
    vectors = integers(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), TOP)


HEAD_GROUP = 100
HEAD_TURNS = 6

TRIE_SQL = f"""
WITH
turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT c, c - c % {HEAD_GROUP} AS base, {_CRC_SQL.format("c::VARCHAR")} % {HEAD_TURNS} AS h
    FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
    SELECT v.c, 0 AS part, t.n, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.n <= v.h
    UNION ALL
    SELECT v.c, 1, t.n, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.n > v.h),
placed AS (
    SELECT c, text, row_number() OVER w AS depth,
           string_agg(sha256(strlen(role)::VARCHAR || ':' || role || text), '') OVER w AS path
    FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, n)),
steps AS (
    SELECT c, depth, path, length(text) AS n_chars FROM placed
    UNION ALL SELECT c, 0, '', 0 FROM convs),
named AS (SELECT c, depth, n_chars, min(c) OVER (PARTITION BY depth, path) AS name FROM steps),
lengths AS (SELECT c, max(depth) AS depth FROM named GROUP BY c),
nodes AS (
    SELECT n.depth, n.name, count(*) AS n_convs, (count(*) - 1) * max(n.n_chars) AS saved,
           string_agg(CASE WHEN l.depth = n.depth THEN n.c::VARCHAR END, ',' ORDER BY n.c) AS ends
    FROM named n JOIN lengths l ON l.c = n.c GROUP BY n.depth, n.name),
parents AS (
    SELECT o.depth, o.name, p.name AS parent
    FROM nodes o LEFT JOIN named p ON p.c = o.name AND p.depth = o.depth - 1),
children AS (SELECT depth - 1 AS depth, parent AS name, count(*) AS n FROM parents WHERE depth > 0 GROUP BY ALL),
totals AS (
    SELECT a.depth, a.name, sum(o.saved)::BIGINT AS saved, (count(*) FILTER (WHERE k.n IS NULL))::BIGINT AS leaves
    FROM nodes o LEFT JOIN children k ON k.depth = o.depth AND k.name = o.name
    JOIN named a ON a.c = o.name AND a.depth <= o.depth GROUP BY a.depth, a.name)
SELECT o.name AS conv_id, o.depth, p.parent AS parent_conv_id, o.n_convs, coalesce(k.n, 0) AS n_children,
       t.leaves AS n_leaves, t.saved AS saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
FROM nodes o JOIN parents p ON p.depth = o.depth AND p.name = o.name
JOIN totals t ON t.depth = o.depth AND t.name = o.name
LEFT JOIN children k ON k.depth = o.depth AND k.name = o.name
"""


@query("op13_prefix_trie", TRIE_SQL)
def op13(spark, folder):
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return trie.prefix_trie(trie.rebuilt(conversations, group=HEAD_GROUP, heads=HEAD_TURNS))
