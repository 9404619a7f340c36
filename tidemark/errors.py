"""Errors raised while a job is being planned, before anything is written."""


class TidemarkError(Exception):
    """Base of all errors raised by this package."""


class UnsupportedType(TidemarkError):
    """A column type that has no canonical text (arrays, maps, structs)."""


class ColumnMismatch(TidemarkError):
    """A column name that matches no column, or more than one."""


class KeyProblem(TidemarkError):
    """Merge keys that are missing, absent from the data, or repeated."""


class CommitConflict(TidemarkError):
    """Another writer published the same target version first."""


class VerifyFailed(TidemarkError):
    """The rows written are not the rows read."""
