"""Errors raised before a job starts, so that a bad input fails fast and by name."""


class SchemaDriftError(TypeError):
    """A landed column has a type that no safe cast brings to its contract type."""


class MissingColumnError(LookupError):
    """A required contract column is in none of the landed files."""


class MissingRoleError(LookupError):
    """A rule or an answer needs a part that no column of the trip type plays."""


class NoLandedPeriodsError(ValueError):
    """None of the expected periods has landed."""
