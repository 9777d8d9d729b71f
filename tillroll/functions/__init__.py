from tillroll.functions import calendar, numeric, text  # noqa: F401
