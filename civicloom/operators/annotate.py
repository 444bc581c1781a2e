"""Labelling rows with a function of the caller: batches, requests, answers, look-ups."""

from __future__ import annotations

import inspect
import math
import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.functions.answers import FAILED, ITEM_TYPE, answer_for, read_answers
from civicloom.functions.labels import label_description
from civicloom.functions.text import present_flag, star_text
from civicloom.operators.filters import filter_has_evidence, has_coordinates, split_by_status
from civicloom.operators.join import LABEL, REASON, left_join_once, union_cached_and_new
from civicloom.operators.journal import JournalWriter, known_rows, row_key
from civicloom.operators.numbering import assign_batches
from civicloom.session import pin

# Columns of a request and what stands in for a column the table does not have.
REQUEST_ROLES = {
    "type": "ไม่ระบุ",
    "organization": "",
    "address": "",
    "comment": "",
    "state": "",
    "photo": "",
    "photo_after": "",
    "star": "",
}
# Calls under way at a time unless the caller says otherwise.
PARALLEL_CALLS = 16


def request_text(
    df: DataFrame, id_col: str, pos_col: str = "pos", roles: dict[str, str] | None = None
) -> Column:
    """The lines of one row. ``roles`` maps the names above to columns of the table."""
    named = {**{role: role for role in REQUEST_ROLES}, **(roles or {})}

    def value(role: str) -> Column:
        name = named[role]
        column = F.col(name) if name in df.columns else F.lit(REQUEST_ROLES[role])
        return column.cast("string")

    def line(title: str, role: str, wanted: Column | None = None) -> Column:
        there = value(role).isNotNull() if wanted is None else wanted
        return F.when(there, F.concat(F.lit(f"{title}: "), value(role), F.lit("\n")))

    # The wording of a request.
    heading = F.format_string(
        "--- เรื่องร้องเรียนที่ %d (Ticket ID: %s) ---\n",
        F.col(pos_col).cast("int"),
        F.col(id_col).cast("string"),
    )
    state = F.when(value("state").isNotNull(), F.concat(F.lit("สถานะ: "), value("state")))
    after = F.when(present_flag(value("photo_after")), "มีรูปหลังแก้ไข: ใช่").otherwise("มีรูปหลังแก้ไข: ไม่")
    rated = df.schema[named["star"]].dataType if named["star"] in df.columns else None
    star = F.concat(
        F.lit("คะแนนความพึงพอใจ: "),
        star_text(value("star"), isinstance(rated, (T.NumericType,))),
    )
    outcome = F.concat(F.lit("ข้อมูล Outcome: "), F.concat_ws(", ", state, after, star), F.lit("\n"))
    return F.concat_ws(
        "",
        heading,
        line("ประเภทปัญหา", "type"),
        line("หน่วยงานรับผิดชอบ", "organization"),
        line("ที่อยู่/สถานที่", "address", present_flag(value("address"))),
        line("รายละเอียด", "comment"),
        outcome,
        F.lit("\n"),
    )


def build_requests(
    batched: DataFrame,
    id_col: str,
    roles: dict[str, str] | None = None,
    prompt: str = "",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per batch: the request text, the ``members`` (position, id, and the columns of
    ``carry``) in order, and the ``photos`` (position, id, reference) of those that have one. A
    list never holds more than one batch."""
    photo = {**{role: role for role in REQUEST_ROLES}, **(roles or {})}["photo"]
    reference = F.col(photo).cast("string") if photo in batched.columns else F.lit(None).cast("string")
    rows = batched.select(
        "batch_num",
        F.struct(
            F.col("pos").cast("int").alias("pos"),
            F.col(id_col).cast("string").alias("ticket_id"),
            request_text(batched, id_col, roles=roles).alias("text"),
            F.when(present_flag(reference), reference).alias("photo"),
            *carry,
        ).alias("row"),
    )
    lists = rows.groupBy("batch_num").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return lists.select(
        "batch_num",
        F.concat(F.lit(prompt), F.array_join(F.col("rows.text"), "")).alias("request"),
        F.transform(
            "rows", lambda r: F.struct(r["pos"], r["ticket_id"], *[r[name].alias(name) for name in carry])
        ).alias("members"),
        F.transform(
            F.filter("rows", lambda r: r["photo"].isNotNull()),
            lambda r: F.struct(r["pos"], r["ticket_id"], r["photo"]),
        ).alias("photos"),
    )


def _takes_photos(fn: Callable) -> bool:
    try:
        inspect.signature(fn).bind("", [])
    except TypeError:
        return False
    return True


def call_per_batch(
    requests: DataFrame, fn: Callable[..., str], journal: str | None = None, journal_every: int = 1
) -> DataFrame:
    """Adds ``answer`` and ``error``: the function's result, or the text of what it raised.
    A batch that fails leaves the others alone.

    ``fn(request)`` gets the text. A function of two parameters, ``fn(request, photos)``, also
    gets the batch's photos: dictionaries of ``pos``, ``ticket_id`` and ``photo``, the reference
    as the table has it; fetching is the function's business.

    With ``journal`` every answer, error included, is added to that folder as soon as
    ``journal_every`` of a task have come; the members then carry their ``key``.
    """
    with_photos = _takes_photos(fn)

    @F.pandas_udf("answer string, error string")
    def call(texts: pd.Series, photos: pd.Series, members: pd.Series) -> pd.DataFrame:
        def one(text: str, listed) -> tuple[str | None, str | None]:
            try:
                return (fn(text, [dict(photo) for photo in listed]) if with_photos else fn(text)), None
            except Exception as problem:
                return None, str(problem)

        if journal is None:
            return pd.DataFrame([one(*row) for row in zip(texts, photos)], columns=["answer", "error"])
        writer, rows = JournalWriter(journal, journal_every), []
        try:
            for text, listed, asked in zip(texts, photos, members):
                rows.append(one(text, listed))
                writer.add(asked, *rows[-1])
        finally:
            writer.flush()
        return pd.DataFrame(rows, columns=["answer", "error"])

    called = requests.withColumn("_called", call.asNondeterministic()("request", "photos", "members"))
    return called.select("*", "_called.answer", "_called.error").drop("_called")


def parse_answers(answers: DataFrame, answer_col: str = "answer") -> DataFrame:
    """Usable entries of each batch's answer: ``(batch_num, id, code, reasoning)``. Of several
    entries with one id the last counts. Answers that fail as a whole give no rows."""
    # Exploding the bare column would make Catalyst filter on its size below, reading each answer
    # over again.
    items = read_answers(answers.select("batch_num", answer_col), answer_col).select(
        "batch_num",
        F.posexplode(F.coalesce("items", F.array().cast(ITEM_TYPE))).alias("place", "item"),
    )
    last = F.max_by(F.struct("item.code", "item.reasoning"), "place")
    return (
        items.groupBy("batch_num", F.col("item.id").alias("id"))
        .agg(last.alias("last"))
        .select("batch_num", "id", "last.code", "last.reasoning")
    )


def match_answers(
    answered: DataFrame,
    answer_col: str = "answer",
    error_col: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per asked id, in the order asked: ``(batch_num, pos, ticket_id, code,
    reasoning)``, then the members' columns of ``carry``. Question and answer are in one row, so
    nothing is shuffled."""
    asked = read_answers(answered, answer_col, error_col)
    matched = F.transform(
        "members",
        lambda member: F.struct(
            member["pos"].alias("pos"),
            member["ticket_id"].alias("ticket_id"),
            answer_for(member["ticket_id"]).alias("result"),
            *[member[name].alias(name) for name in carry],
        ),
    )
    return asked.select("batch_num", F.explode(matched).alias("m")).select(
        "batch_num", "m.pos", "m.ticket_id", "m.result.code", "m.result.reasoning", *[f"m.{name}" for name in carry]
    )


def label_rows(
    pending: DataFrame,
    fn: Callable[..., str],
    order_by: Sequence[str],
    id_col: str = "ticket_id",
    roles: dict[str, str] | None = None,
    batch_size: int = 20,
    parallelism: int = PARALLEL_CALLS,
    prompt: str = "",
    journal: str | None = None,
    ask_again: tuple[str, ...] = (FAILED,),
    journal_every: int = 1,
) -> DataFrame:
    """Label every row: ``(batch_num, pos, ticket_id, code, llm_label, llm_reasoning)``.

    ``parallelism`` is the number of tasks that call the function, so the number of calls under
    way is bounded by it and by the executors' cores. Answers are written once, since the
    function may cost money and need not give the same answer twice.

    ``journal`` names a folder for answers as they come; every executor must reach it by the file
    systems of ``pyarrow``. A run that fails loses at most ``journal_every`` answers of a task, and
    the next run with the journal asks only for rows without a usable answer: whose request, prompt
    or photo is new, or whose code is in ``ask_again``. These rows are put into batches of their
    own; ``batch_num`` and ``pos`` of the result number all rows, as if none had been known.
    """
    # What is numbered is also written, so take along only what a request holds.
    named = {**{role: role for role in REQUEST_ROLES}, **(roles or {})}
    wanted = {id_col, *order_by, *named.values()}
    narrow = pending.select(*[name for name in pending.columns if name in wanted])
    batched = assign_batches(narrow, order_by, batch_size)
    carry = () if journal is None else ("key", "place")
    known = None
    if journal is not None:
        alone = batched.withColumn("_alone", F.lit(1))
        photo = F.col(named["photo"]).cast("string") if named["photo"] in batched.columns else F.lit(None).cast("string")
        keyed = pin(
            alone.withColumns({
                "key": row_key(request_text(alone, id_col, "_alone", roles), photo, prompt),
                "place": F.struct("batch_num", "pos"),
            }).drop("_alone", "batch_num", "pos"),
            "keyed",
        )
        answers = known_rows(pending.sparkSession, journal, ask_again)
        known = keyed.join(answers, "key").select(
            "place.batch_num", "place.pos", F.col(id_col).cast("string").alias("ticket_id"), "code", "reasoning")
        batched = assign_batches(keyed.join(answers, "key", "left_anti"), ["place"], batch_size)
    requests = build_requests(batched.repartition(parallelism, "batch_num"), id_col, roles, prompt, carry)
    called = call_per_batch(requests, fn, journal, journal_every)
    answered = pin(called.drop("request", "photos"), "answers")
    matched = match_answers(answered, error_col="error", carry=carry)
    if known is not None:
        matched = matched.select("place.batch_num", "place.pos", "ticket_id", "code", "reasoning").unionByName(known)
    return matched.select(
        "batch_num",
        "pos",
        "ticket_id",
        "code",
        label_description(F.col("code")).alias(LABEL),
        F.col("reasoning").alias(REASON),
    )


def pending_rows(
    df: DataFrame, roles: dict[str, str] | None = None, label_col: str = LABEL
) -> DataFrame:
    """Rows to label: without a label or with one worth another try, and with a comment or a
    photo to go by."""
    named = roles or {}
    comment, photo = named.get("comment", "comment"), named.get("photo", "photo")
    added = [name for name in (comment, photo) if name not in df.columns]
    complete = df.withColumns({name: F.lit(None).cast("string") for name in added})
    unsettled = split_by_status(complete, label_col).filter(F.col("status") != "cached")
    return filter_has_evidence(unsettled, comment, photo).drop("status", *added)


def annotate(
    df: DataFrame,
    fn: Callable[..., str],
    order_by: Sequence[str],
    id_col: str = "ticket_id",
    roles: dict[str, str] | None = None,
    batch_size: int = 20,
    parallelism: int = PARALLEL_CALLS,
    prompt: str = "",
    journal: str | None = None,
    ask_again: tuple[str, ...] = (FAILED,),
) -> DataFrame:
    """Labels of all rows, old and new: ``(ticket_id, llm_label, llm_reasoning, batch_num, pos)``.

    Rows with a good label keep it (their batch and position are 0); the others are labelled if
    they hold a comment or a photo. The result is what ``merge_labels_upsert`` takes, ordered by
    batch and position. ``journal`` and ``ask_again`` are those of ``label_rows``. The input is evaluated once: its ids, labels and, for the rows to label,
    what a request holds are written and gone on from.
    """
    for name in (LABEL, REASON):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    named = {**{role: role for role in REQUEST_ROLES}, **(roles or {})}
    kept = {id_col, LABEL, REASON, *order_by}
    asked = [name for name in dict.fromkeys(named.values()) if name in df.columns and name not in kept]
    pending_now = F.col("status") != "cached"
    narrow = split_by_status(df, LABEL).select(
        *kept, *[F.when(pending_now, F.col(name)).alias(name) for name in asked]
    )
    df = pin(narrow, "to-label")
    cached = split_by_status(df, LABEL).filter(F.col("status") == "cached").select(
        F.col(id_col).cast("string").alias("ticket_id"),
        LABEL,
        REASON,
        F.lit(0).cast("bigint").alias("batch_num"),
        F.lit(0).alias("pos"),
    )
    pending = pending_rows(df, roles)
    new = label_rows(
        pending, fn, order_by, id_col, roles, batch_size, parallelism, prompt, journal, ask_again)
    return union_cached_and_new(cached, new.drop("code"))


class _Slots:
    """Slots of time that tasks own in turn, counted from the clock all of them share."""

    def __init__(self, length: float, tasks: int, task: int):
        self.length, self.turn, self.offset = length, length * tasks, length * (task % tasks)

    def wait(self) -> None:
        """Until the next slot of this task begins."""
        if self.length <= 0:
            return
        now = time.time()
        begin = math.ceil((now - self.offset) / self.turn) * self.turn + self.offset
        while (left := begin - time.time()) > 0:
            time.sleep(left)


def lookup(
    df: DataFrame,
    fn: Callable[[str], tuple[float, float] | None],
    name_col: str,
    gazetteer: DataFrame | None = None,
    gazetteer_name: str = "name",
    tries: int = 3,
    pause: float = 1.0,
    pause_between: float = 0.2,
    parallelism: int = PARALLEL_CALLS,
    lat_col: str = "latitude",
    lon_col: str = "longitude",
    status_col: str | None = None,
) -> DataFrame:
    """Fill missing coordinates from the gazetteer and, for names it lacks, from a function.

    Every name is asked for once, however many rows hold it. ``None`` is a final answer; an
    exception is tried again, ``tries`` times in all, after ``pause`` seconds and twice as long for
    every failure that follows another in a task, up to a minute.

    All tasks together ask once in ``pause_between`` seconds: time is divided into slots of that
    length, which the ``parallelism`` tasks own in turn, and a task asks at the beginning of a slot
    of its own. Clocks of the executors must agree to a part of a slot.
    ``status_col`` adds how a row that needed coordinates fared: ``known`` (gazetteer),
    ``found``, ``not found``, or ``failed`` (every try raised); null for the other rows.
    """

    @F.pandas_udf("lat double, lon double, status string")
    def locate(names: pd.Series) -> pd.DataFrame:
        slots = _Slots(pause_between, parallelism, TaskContext.get().partitionId())
        failures = 0

        def one(name: str) -> tuple[float | None, float | None, str]:
            nonlocal failures
            for attempt in range(tries):
                if attempt:
                    time.sleep(min(60.0, pause * 2 ** (failures - 1)))
                slots.wait()
                try:
                    answer = fn(name)
                except Exception:
                    failures += 1
                    continue
                failures = 0
                return (*answer, "found") if answer else (None, None, "not found")
            return None, None, "failed"

        return pd.DataFrame([one(name) for name in names], columns=["lat", "lon", "status"])

    wanted = ~has_coordinates(lat_col, lon_col) & present_flag(F.col(name_col))
    names = df.filter(wanted).select(F.col(name_col).alias("name")).distinct()
    known = None
    if gazetteer is not None:
        known = gazetteer.filter(has_coordinates(lat_col, lon_col)).select(
            F.col(gazetteer_name).alias("name"), lat_col, lon_col
        )
        names = names.join(known, "name", "left_anti")
    asked = names.repartition(parallelism, "name").select(
        "name", locate.asNondeterministic()("name").alias("at")
    )
    found = pin(
        asked.select("name", F.col("at.lat").alias(lat_col), F.col("at.lon").alias(lon_col),
                     F.col("at.status").alias("_status")),
        "places",
    )
    places = found if known is None else known.withColumn("_status", F.lit("known")).unionByName(found)
    one = F.min_by(F.struct(F.col(lat_col).alias("lat"), F.col(lon_col).alias("lon")),
                   F.struct(F.col(lat_col), F.col(lon_col))).alias("_at")
    unique = places.groupBy(F.col("name").alias(name_col)).agg(one, F.min("_status").alias("_status"))
    joined = left_join_once(df, pin(unique, "places"), name_col, wanted)
    filled = {lat_col: F.coalesce("_at.lat", F.col(lat_col)), lon_col: F.coalesce("_at.lon", F.col(lon_col))}
    added = [] if status_col is None else [F.col("_status").alias(status_col)]
    return joined.select(
        *[filled[name].alias(name) if name in filled else F.col(name) for name in df.columns], *added
    )
