"""Who registered and who attended: from landed webinar pages and in-person events to flags.

All session types go through one relation (tax id, session, registered, attended), so that the 26
flags cost one aggregation and one join instead of a pass per session. A session without any record
simply has no rows, which gives False flags.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlane import fixed_values as V
from rosterlane.functions.ids import normalize_id
from rosterlane.functions.text import trim_ws
from rosterlane.operators.aggregates import marks_by_key
from rosterlane.operators.columns import questions_to_columns, quoted, union_ragged
from rosterlane.operators.joins import left_join
from rosterlane.schemas import FLAG_SUFFIXES, FLAGS
from rosterlane.sources.chains import COMPLETE, NEXT_TOKEN, PAGE_TOKEN, page_chains
from rosterlane.sources.pages import BROKEN, explode_records

# What pages are asked for, and the session of what concerns every one of them.
WEBINAR_ID, UUID = "webinar_id", "uuid"
ALL_SESSIONS = "all sessions"


def session_topics(df: DataFrame, sessions: Sequence[V.Session] = V.SESSIONS) -> DataFrame:
    """The session types as a table (a dozen rows) for a broadcast join."""
    return df.sparkSession.createDataFrame(
        [(s.suffix, s.topic, s.trim_topic) for s in sessions],
        "SESSION string, topic_key string, trim_topic boolean",
    )


def webinar_sessions(catalogue: DataFrame, sessions: Sequence[V.Session] = V.SESSIONS) -> DataFrame:
    """(webinar_id, SESSION) of the catalogue's webinars whose topic is one of the session types.

    Topics are compared exactly; for some types the catalogue's topic is trimmed before.
    """
    keys = F.explode(
        F.array(
            F.struct(F.col("topic").alias("topic_key"), F.lit(False).alias("trim_topic")),
            F.struct(trim_ws(F.col("topic")).alias("topic_key"), F.lit(True).alias("trim_topic")),
        )
    )
    return (
        catalogue.select(F.col("id").cast("string").alias("webinar_id"), keys.alias("topic"))
        .select("webinar_id", "topic.*")
        .join(F.broadcast(session_topics(catalogue, sessions)), ["topic_key", "trim_topic"])
        .select("webinar_id", "SESSION")
        .distinct()
    )


def webinar_participation(
    catalogue_pages: DataFrame,
    instance_pages: DataFrame,
    participant_pages: DataFrame,
    registrant_pages: DataFrame,
    upcoming_pages: DataFrame | None = None,
    sessions: Sequence[V.Session] = V.SESSIONS,
    question: str = V.TAX_ID_QUESTION,
    account: DataFrame | None = None,
) -> DataFrame:
    """(TAX_ID, SESSION, REGISTERED, ATTENDED) out of landed pages.

    Pages and their parent ids: catalogue ``webinars``; instances ``webinars`` (webinar_id);
    participants ``participants`` (uuid); registrants ``registrants`` (webinar_id), of past
    occurrences and of webinars still to come. A registrant attended when one of the session's
    participants carries the registrant's id and was in the meeting.

    ``account``: what ``page_account`` says of these pages. A session with an unusable page has no rows
    then, so that its flags are False, while all others go on.
    """
    webinars = webinar_sessions(explode_records(catalogue_pages, "webinars"), sessions)
    if account is not None:
        # At most a dozen sessions, and one row for the catalogue, without which there is none.
        unusable = account.where("not usable and SESSION is not null").select(F.col("SESSION").alias("unusable"))
        lost = F.col("unusable").isin(ALL_SESSIONS) | (F.col("unusable") == F.col("SESSION"))
        webinars = webinars.join(F.broadcast(unusable.distinct()), lost, "anti")

    registrants = explode_records(registrant_pages, "registrants", ["webinar_id"])
    if upcoming_pages is not None:
        upcoming = explode_records(upcoming_pages, "registrants", ["webinar_id"])
        registrants = union_ragged(registrants, upcoming)
    answers = questions_to_columns(registrants, "custom_questions", {question: "answer"})
    registered = (
        answers.select("webinar_id", "id", normalize_id(F.col("answer")).alias("TAX_ID"))
        .where(F.col("TAX_ID").isNotNull())
        .join(webinars, "webinar_id")
        .select("SESSION", "id", "TAX_ID")
        .distinct()
    )

    instances = explode_records(instance_pages, "webinars", ["webinar_id"])
    present = (
        explode_records(participant_pages, "participants", ["uuid"])
        .where(F.col("status") == V.IN_MEETING)
        .select("uuid", "registrant_id")
        .join(instances.select("webinar_id", "uuid").distinct(), "uuid")
        .join(webinars, "webinar_id")
        .select("SESSION", "registrant_id")
        .distinct()
        .withColumn("ATTENDED", F.lit(True))
    )
    # A registrant of a session occurs once for each tax id that was answered.
    joined = left_join(
        registered,
        present,
        ["SESSION", "id"],
        ["SESSION", "registrant_id"],
        unique=True,
        even=True,
    )
    return joined.select(
        "TAX_ID",
        "SESSION",
        F.lit(True).alias("REGISTERED"),
        F.coalesce("ATTENDED", F.lit(False)).alias("ATTENDED"),
    )


def page_account(
    catalogue_pages: DataFrame,
    instance_pages: DataFrame,
    participant_pages: DataFrame,
    registrant_pages: DataFrame,
    upcoming_pages: DataFrame | None = None,
    sessions: Sequence[V.Session] = V.SESSIONS,
) -> DataFrame:
    """(KIND, SESSION, PAGES, BROKEN, OPEN_CHAINS, usable): per kind of page and session, how many pages
    landed, how many are broken, and how many chains of pages do not come to their end.

    The catalogue counts for all sessions and has none of its own (ALL_SESSIONS); a page of it without
    its array is as good as broken. Pages of a session that is not reported or can't be made out have no
    session. Broken pages are seen where the pages keep them (``keep_broken``), chains where they say
    with which token they were asked for (``tokens``); what is in no such column counts as sound.
    """
    webinars = webinar_sessions(explode_records(catalogue_pages, "webinars"), sessions)
    instances = explode_records(instance_pages, "webinars", [WEBINAR_ID]).select(WEBINAR_ID, UUID)
    by_uuid = instances.join(webinars, WEBINAR_ID).select(UUID, "SESSION").distinct()
    whole = catalogue_pages.withColumn(ALL_SESSIONS, F.lit(ALL_SESSIONS))
    alone = webinars.sparkSession.createDataFrame([(ALL_SESSIONS, ALL_SESSIONS)], f"`{ALL_SESSIONS}` string, SESSION string")
    kinds = [
        ("catalogue", whole, "webinars", ALL_SESSIONS, alone),
        ("instances", instance_pages, "webinars", WEBINAR_ID, webinars),
        ("participants", participant_pages, "participants", UUID, by_uuid),
        ("registrants", registrant_pages, "registrants", WEBINAR_ID, webinars),
    ]
    if upcoming_pages is not None:
        kinds.append(("upcoming", upcoming_pages, "registrants", WEBINAR_ID, webinars))
    return reduce(DataFrame.unionByName, (_account(*kind) for kind in kinds))


def _account(kind: str, pages: DataFrame, records: str, parent: str, of_session: DataFrame) -> DataFrame:
    """The account of one kind of page: counted per parent first, so a hot one is no burden."""
    broken = F.col(quoted(BROKEN)).isNotNull() if BROKEN in pages.columns else F.lit(False)
    if kind == "catalogue":
        broken |= F.col(records).isNull()
    counts = pages.groupBy(parent).agg(F.count("*").alias("PAGES"), F.count_if(broken).alias("BROKEN"))
    counts = counts.withColumn("OPEN_CHAINS", F.lit(0).cast("long"))
    if PAGE_TOKEN in pages.columns:
        sound = pages.where(~broken)
        parents = [c for c in sound.columns if c not in (records, NEXT_TOKEN, PAGE_TOKEN, BROKEN)]
        chains = page_chains(sound, parents).where(F.col("state") != COMPLETE)
        opened = chains.select(
            parent, *(F.lit(0).cast("long").alias(n) for n in ("PAGES", "BROKEN")), F.lit(1).cast("long").alias("OPEN_CHAINS")
        )
        counts = counts.unionByName(opened)
    sums = [F.sum(n).alias(n) for n in ("PAGES", "BROKEN", "OPEN_CHAINS")]
    met = counts.groupBy(parent).agg(*sums).join(of_session, parent, "left")
    return (
        met.groupBy("SESSION")
        .agg(*sums)
        .select(
            F.lit(kind).alias("KIND"),
            "SESSION",
            "PAGES",
            "BROKEN",
            "OPEN_CHAINS",
            ((F.col("BROKEN") == 0) & (F.col("OPEN_CHAINS") == 0)).alias("usable"),
        )
    )


def inperson_participation(engagements: DataFrame, suffix: str = V.INPERSON_SUFFIX) -> DataFrame:
    """The same relation for in-person events, where either kind of engagement stands alone."""
    kind = F.col("MARKETING_ENGAGEMENT_TYPE")
    return engagements.where(kind.isin(V.EVENT_REGISTRATION, V.EVENT_ATTENDANCE)).select(
        "TAX_ID",
        F.lit(suffix).alias("SESSION"),
        (kind == V.EVENT_REGISTRATION).alias("REGISTERED"),
        (kind == V.EVENT_ATTENDANCE).alias("ATTENDED"),
    )


def session_marks(suffixes: Sequence[str] = FLAG_SUFFIXES) -> dict[str, Column]:
    """Predicates of the flag pairs over the participation relation."""
    return {
        f"{mark}_{suffix}": (F.col("SESSION") == F.lit(suffix)) & F.col(mark)
        for suffix in suffixes
        for mark in ("ATTENDED", "REGISTERED")
    }


def participation_flags(
    participation: DataFrame, suffixes: Sequence[str] = FLAG_SUFFIXES
) -> DataFrame:
    """One row per tax id with the flag pairs of all sessions."""
    return marks_by_key(participation, "TAX_ID", session_marks(suffixes))


def attach_flags(
    df: DataFrame, flags: DataFrame, on: str, flags_on: str, names: Sequence[str] = FLAGS
) -> DataFrame:
    """Left join of unique flag rows; a key without a row has every flag False.

    ``df`` has few rows per key, as the roster after it was made unique.
    """
    joined = left_join(df, flags, on, flags_on, unique=True, even=True)
    if flags_on != on:
        joined = joined.drop(flags_on)
    return joined.fillna(False, subset=list(names))
