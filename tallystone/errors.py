"""Errors of the engine."""


class EngineError(Exception):
    """A statement or definition that the engine refuses."""


class UnsupportedOperation(EngineError):
    """Something that the SQL dialect knows and the engine does not do."""


class DuplicateKey(EngineError):
    """A commit that would give a table two rows of one key."""
