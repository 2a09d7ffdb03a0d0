"""Quoting of text that goes into SQL."""


def sql_text(text: str) -> str:
    """A SQL string literal that holds exactly `text`."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
