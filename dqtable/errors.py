"""The two errors the toolkit raises itself; Spark's own errors pass through unwrapped."""


class ContractError(ValueError):
    """A table cannot be read as its contract says (missing, repeated or unknown columns)."""


class EmptyResultError(RuntimeError):
    """A table that must hold rows was written without any."""
