"""Column-level helpers. All built-in expressions: they stay inside
whole-stage codegen and never leave the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from teampulse import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(t: dt.datetime) -> Column:
    """A timestamp-without-zone literal; independent of the session zone."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def login_key(login) -> Column:
    """Identity of an engineer: the login folded to lower case."""
    return F.lower(_col(login))


def is_bot(user, extra_bots: tuple[str, ...] = ()) -> Column:
    """True for automation accounts.

    ``user`` is the nested user object of a payload (struct with ``login`` and
    ``type``). A missing or empty object counts as a bot; otherwise type
    ``Bot``, a login (case-folded) in the bot list, or a login containing
    ``[bot]`` (case-sensitive) marks a bot.
    """
    u = _col(user)
    login = F.coalesce(u.getField("login"), F.lit(""))
    utype = u.getField("type")
    empty = u.isNull() | (u.getField("login").isNull() & utype.isNull())
    names = list(K.BOT_LOGINS) + [b.lower() for b in extra_bots]
    return (empty
            | F.coalesce(utype == F.lit(K.BOT_TYPE), F.lit(False))
            | F.lower(login).isin(names)
            | login.contains(K.BOT_MARKER))


def in_window(ts, as_of: dt.datetime, days: int) -> Column:
    """``ts >= as_of - days`` (inclusive); ``days`` must be a valid window."""
    if days not in K.VALID_DAYS:
        raise ValueError(f"days must be one of {sorted(K.VALID_DAYS)}")
    return _col(ts) >= ts_lit(as_of - dt.timedelta(days=days))


def since_second(ts, since: dt.datetime) -> Column:
    """Extraction window compared at whole-second precision: ISO strings
    compare equal-second values as not-earlier, whatever the fraction."""
    return _col(ts) >= ts_lit(since.replace(microsecond=0))


def commit_type(message) -> Column:
    """Conventional-commit class of the raw (untrimmed) message."""
    m = _col(message)
    expr = None
    for prefix, label in K.COMMIT_TYPES:
        cond = m.ilike(prefix + "%")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(K.COMMIT_TYPE_OTHER)


def discussion_level(total) -> Column:
    """Level of the raw ``review_comments + comments``; NULL falls to high."""
    t = _col(total)
    return (F.when(t == 0, "no-discussion")
            .when(t <= K.DISCUSSION_LOW_MAX, "low")
            .when(t <= K.DISCUSSION_MEDIUM_MAX, "medium")
            .otherwise("high"))


def hours_between(start, end) -> Column:
    """Elapsed hours as double; NULL when either side is NULL."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(3.6e9)


def elapsed_micros(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def mean_hours(micros) -> Column:
    """Mean of elapsed microseconds in hours: whole numbers are summed and
    divided once, so the order of the rows does not matter."""
    return F.try_divide(F.sum(_col(micros)), F.count(_col(micros))) / F.lit(3.6e9)


def week_start(ts) -> Column:
    """Monday 00:00 of the ISO week holding ``ts`` (timestamp without zone)."""
    d = F.to_date(_col(ts))
    return F.next_day(F.date_sub(d, 7), "Mon").cast("timestamp_ntz")


def impact_score(prs, changes, reviews, issues, commits, approvals) -> Column:
    return (_col(prs) * K.W_PRS + _col(changes) * K.W_CHANGES + _col(reviews) * K.W_REVIEWS
            + _col(issues) * K.W_ISSUES + _col(commits) * K.W_COMMITS
            + _col(approvals) * K.W_APPROVALS)


def weekly_score(prs, changes, reviews, commits) -> Column:
    return (_col(prs) * K.W_PRS + _col(changes) * K.W_CHANGES
            + _col(reviews) * K.W_REVIEWS + _col(commits) * K.W_COMMITS)
