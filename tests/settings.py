"""Session settings for the length of a block."""

from contextlib import contextmanager


@contextmanager
def session_settings(spark, settings):
    """Settings for the duration of one action."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
