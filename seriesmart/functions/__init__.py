from . import dates, text  # noqa: F401
