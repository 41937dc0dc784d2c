from pacelake.streaming.refresh import refresh  # noqa: F401
