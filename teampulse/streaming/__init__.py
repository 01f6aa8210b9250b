from teampulse.streaming.daily_load import read_current, start_daily_load  # noqa: F401
