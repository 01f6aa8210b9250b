from teampulse.functions.columns import (  # noqa: F401
    commit_type, discussion_level, elapsed_micros, hours_between, impact_score, in_window,
    is_bot, login_key, mean_hours, since_second, ts_lit, weekly_score, week_start,
)
