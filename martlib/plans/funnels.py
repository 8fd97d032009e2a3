"""Funnel plans: signups and connection requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.functions.dates import diff_seconds, trunc_to
from martlib.functions.text import mask_generated, surrogate_key
from martlib.operators.aggregates import agg_if, clamped_count, min_by_nn, summarize
from martlib.operators.joins import role_join, time_tolerant_full_join
from martlib.operators.ordered import DenseRank, FirstValue, LastValue, Total, ordered
from martlib.operators.windows import keep_first
from martlib.plans.common import EMPTY_USER_ID, EMPTY_USER_PSEUDO_ID

# Signup step -> column name part.
SIGNUP_STEPS = {
    "email verification sent": "email_verification_sent", "started": "started", "name": "name", "primary usage": "primary_usage",
    "business email": "business_email", "complete skip": "complete_skip", "complete submit": "complete_submit",
}
SIGNUP_KEYS = ["page_location", "page_title", "action", "platform", "type", "step", "origin"]


def signup_events(
    long: DataFrame, users: DataFrame, *, split: bool = True, empty_user: str = EMPTY_USER_ID, empty_pseudo: str = EMPTY_USER_PSEUDO_ID
) -> DataFrame:
    """One row per signup step with the attempt it belongs to.

    Steps repeated within a minute count once. The attempt number counts the
    starts and is carried on to later steps; the verification mail takes it
    from the next start.
    """
    c, t = F.col, "event_datetime_utc"
    src = long.filter(c("event_name").isin("sign_up", "profile_data") & c("event_key").isin(*SIGNUP_KEYS))
    src = src.withColumn("user_id", F.nullif("user_id", F.lit(empty_user)))
    value = c("event__string_value")
    of = lambda k: min_by_nn(F.when(c("event_key") == k, value), t)
    step = F.when(c("event_name") == "sign_up", "started").when((c("event_name") == "profile_data") & (c("event_key") == "step"), value)
    steps = summarize(src, ["user_id", "user_pseudo_id", "session_id", "event_id", t], {
        "page_location": of("page_location"), "page_title": of("page_title"), "signup_origin": of("origin"),
        "signup_platform": of("platform"), "signup_type": of("type"), "signup_step": min_by_nn(step, t),
    })
    known = users.select(
        F.nullif("user_pseudo_id", F.lit(empty_pseudo)).alias("user_pseudo_id"), F.nullif("user_id", F.lit(empty_user)).alias("__user"), "signup_start_datetime"
    ).groupBy("user_pseudo_id").agg(min_by_nn("__user", "signup_start_datetime").alias("__user"))
    df = steps.join(known, "user_pseudo_id", "left").withColumn("user_id", F.coalesce("user_id", "__user")).drop("__user")

    df = df.withColumn("__hour", trunc_to(c(t), "hour"))
    df = ordered(df, ["user_id", "signup_platform", "__hour"], [f"-{t}"], {"__type": FirstValue(c("signup_type"))}, split=split)
    df = df.withColumns({"signup_type": F.coalesce("__type", F.lit("new")), "__minute": trunc_to(c(t), "minute")})
    df = keep_first(df, ["user_id", "signup_platform", "signup_type", "signup_step", "__minute"], [t, "event_id"])
    df = df.withColumn("__start", F.when(c("signup_step") == "started", 1).otherwise(0))
    df = ordered(df, ["user_id", "signup_platform", "__start"], [t], {"__rank": DenseRank()}, split=split)
    df = df.withColumn("__rank", F.when(c("__start") == 1, c("__rank")))
    df = ordered(df, ["user_id"], [t], {"__before": LastValue(c("__rank"))}, split=split)
    df = ordered(df, ["user_id"], [f"-{t}"], {"__after": LastValue(c("__rank"))}, split=split)
    carried = F.when(c("signup_step") == "email verification sent", c("__after")).otherwise(c("__before"))
    df = df.withColumns({"signup_attempt": F.coalesce(carried, F.lit(1)), "event_date": c(t).cast("date")})
    return df.drop("__hour", "__type", "__minute", "__start", "__rank", "__before", "__after")


def signup_attempts(events: DataFrame, steps: dict[str, str] | None = None, split: bool = True) -> DataFrame:
    """One row per attempt with the first time of each step.

    The steps of an attempt are pivoted and reduced in one aggregation: the
    minimum over session rows of a step's minimum is the step's minimum.
    """
    c, t = F.col, "event_datetime_utc"
    steps = SIGNUP_STEPS if steps is None else steps
    key = ["user_id", "session_id", "signup_platform", "signup_type"]
    src = ordered(events, key, [], {"__first": Total("min", c(t))}, split=split)
    at = {n: F.min(F.when(c("signup_step") == s, c(t))) for s, n in steps.items()}
    out = summarize(src, ["user_id", "signup_platform", "signup_type", "signup_attempt"], {
        "signup_origin": min_by_nn("signup_origin", "__first"),
        "max_session_id": F.max("session_id"),
        "page_location": min_by_nn("page_location", "__first"),
        "page_title": min_by_nn("page_title", "__first"),
        "signup_start_date": F.min("__first").cast("date"),
        "signup_start_datetime": F.min("__first"),
        "signup_complete_datetime": F.least(at["complete_submit"], at["complete_skip"]),
        **{f"signup_step__{n}__datetime_utc": a for n, a in at.items()},
    })
    return out.select(surrogate_key("user_id", "signup_platform", "signup_type", "signup_attempt").alias("record_id"), *out.columns)


def signup_funnel(long: DataFrame, users: DataFrame, **kw) -> DataFrame:
    """Signup steps pivoted per attempt, straight from the long events."""
    return signup_attempts(signup_events(long, users, **kw), split=kw.get("split", True))


def signups(attempts: DataFrame, sessions: DataFrame, users: DataFrame, dimensions: Sequence[str], session_only: Sequence[str] = ()) -> DataFrame:
    """Last attempt per user together with all users that never signed up.

    ``dimensions`` come from the attempt's session, else the user's latest
    session, else the user table; those in ``session_only`` exist on sessions.
    """
    c = F.col
    last = keep_first(attempts.filter(~c("user_id").startswith("_")), ["user_id"], ["-signup_attempt", "record_id"])
    recent = F.coalesce("user_signup_start_datetime", "user_signup_complete_datetime", c("user_signup_date").cast("timestamp_ntz"))
    ses = sessions.filter(c("user_id").isNotNull())
    best = keep_first(ses.withColumn("__sort", recent), ["user_id"], ["-__sort", "session_id"])
    best = best.select("user_id", c("session_id").alias("__session"), *[c(d).alias(f"__s_{d}") for d in dimensions])
    table = users.select("user_id", F.lit(True).alias("__u"), *[c(d).alias(f"__u_{d}") for d in dimensions if d not in session_only])
    people = best.withColumn("__s", F.lit(True)).join(table, "user_id", "full")
    picked = {
        d: c(f"__s_{d}") if d in session_only else F.when(c("__s"), c(f"__s_{d}")).otherwise(c(f"__u_{d}")) for d in dimensions
    }
    people = people.select("user_id", "__session", *[p.alias(f"__p_{d}") for d, p in picked.items()], F.lit(True).alias("__p"))

    of_attempt = ses.select("user_id", c("session_id").alias("max_session_id"), F.lit(True).alias("__a"), *[c(d).alias(f"__a_{d}") for d in dimensions])
    df = last.join(of_attempt, ["user_id", "max_session_id"], "left")
    df = df.join(people, "user_id", "full")
    df = df.withColumns({
        "record_id": F.coalesce("record_id", surrogate_key("user_id")),
        "session_id": F.coalesce("max_session_id", "__session"),
        **{d: F.when(c("__a"), c(f"__a_{d}")).otherwise(c(f"__p_{d}")) for d in dimensions},
    })
    helpers = [n for n in df.columns if n.startswith("__")] + ["max_session_id"]
    return keep_first(df.drop(*helpers), ["record_id"], ["-signup_start_date", "session_id"])


def invitation_stats(invites: DataFrame, chats: DataFrame, users: DataFrame, members: DataFrame) -> DataFrame:
    """Invitations with the invited company and the message counts of both sides.

    ``chats``: (message_id, channel_id, user_id as chat id, message_datetime).
    The automatic first message of the inviter is not counted.
    """
    c = F.col
    msgs = chats.select("channel_id", "message_id", "message_datetime", c("user_id").alias("__chat"))
    who = users.select(c("chat_id").alias("__chat"), c("user_id").alias("__author"))
    sides = invites.select("channel_id", "inviting_user_id", "invited_user_id")
    joined = sides.join(msgs, "channel_id", "left").join(who, "__chat", "left")
    stats = summarize(joined, ["channel_id"], {
        "inviting_user_messages": clamped_count("message_id", c("__author") == c("inviting_user_id")),
        "invited_user_messages": agg_if("count_distinct", "message_id", c("__author") == c("invited_user_id")),
        "first_message_datetime": F.min("message_datetime"),
        "last_message_datetime": F.max("message_datetime"),
    })
    company = members.select(c("member_id").alias("invited_member_id"), c("company_id").alias("invited_company_id"))
    out = invites.join(company, "invited_member_id", "left").join(stats, "channel_id", "left")
    return out.select(c("channel_id").alias("record_id"), *out.columns)


COMPANY_FIELDS = ["company_name", "company_type", "company_subtype", "company_primary_sector", "company_primary_sector_parent"]


def connection_funnel(
    clicks: DataFrame, invites: DataFrame, companies: DataFrame, users: DataFrame | None = None, user_columns: Sequence[str] = (),
    company_fields: Sequence[str] = tuple(COMPANY_FIELDS), two_sided: bool = False,
) -> DataFrame:
    """Connection clicks matched in time with the invitations they led to.

    ``clicks`` are connection-request events (event_id, event_datetime_utc,
    user_id, company_url_name, step); ``invites`` come from
    ``invitation_stats``. A click run and an invitation match on inviter,
    company and minute, see ``time_tolerant_full_join``.
    """
    c, t = F.col, "event_datetime_utc"
    # the running count of button clicks reaches its maximum at the total
    clicked = c("step") == "Button Clicked"
    flat = summarize(clicks.withColumnRenamed("user_id", "inviting_user_id"), ["inviting_user_id", "company_url_name"], {
        "click_record_id": min_by_nn("event_id", t),
        "clicked_connect_datetime": agg_if("min", t, clicked),
        "sent_datetime": agg_if("min", t, c("step") == "Success"),
        "clicked_connect_counter": F.count_if(clicked),
    })
    named = companies.select("company_id", "company_url_name", *company_fields)
    left = invites.join(
        named.select(c("company_id").alias("invited_company_id"), "company_url_name", *[c(f).alias(f"__i_{f}") for f in company_fields]),
        "invited_company_id", "left",
    )
    right = flat.join(named.select("company_url_name", *[c(f).alias(f"__c_{f}") for f in company_fields]), "company_url_name", "left")
    df = time_tolerant_full_join(
        left.drop("record_id"), right, ["inviting_user_id", "company_url_name"], "invitation_datetime", "sent_datetime", 60, 10, 10, two_sided
    )
    waited = lambda s: F.round(F.when(c("status") == s, diff_seconds(c("status_datetime"), c("invitation_datetime"))) / 86400, 2)
    out = df.select(
        F.coalesce("channel_id", "click_record_id").alias("record_id"), "channel_id", "invite_id",
        F.coalesce("l_inviting_user_id", "r_inviting_user_id").alias("inviting_user_id"), "invited_user_id",
        F.coalesce("l_company_url_name", "r_company_url_name").alias("invited_company_url_name"),
        *[F.coalesce(f"__i_{f}", f"__c_{f}").alias(f"invited_{f}") for f in company_fields],
        "clicked_connect_counter", "clicked_connect_datetime",
        F.coalesce("invitation_datetime", "sent_datetime").alias("invitation_datetime"),
        "status", "status_datetime", "purpose", F.coalesce("reminders", F.lit(0)).alias("reminders"), "last_reminder_datetime",
        waited("accepted").alias("time_to_accept_days"), waited("withdrawn").alias("time_to_withdraw_days"),
        "inviting_user_messages", "invited_user_messages", "first_message_datetime", "last_message_datetime",
    )
    if users is not None:
        out = role_join(out, users, {"inviting_user": "inviting_user_id", "invited_user": "invited_user_id"}, "user_id", user_columns)
    return out.withColumns({u: mask_generated(c(u)) for u in ("inviting_user_id", "invited_user_id")})
