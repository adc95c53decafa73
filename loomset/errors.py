"""Errors raised by the jobs. Each message says what to do next."""


class LoomsetError(Exception):
    """Base of all errors raised on purpose."""


class ConfigError(LoomsetError, ValueError):
    """A job parameter is unknown or has an impossible value."""


class DatasetLoadError(LoomsetError, RuntimeError):
    """The source table could not be read."""

    def __init__(self, name: str, cause: BaseException):
        super().__init__(
            f"Cannot read dataset '{name}'. Check that the path or table exists, that every "
            f"executor may read it, and that JSON rows match the schema. Cause: {cause}"
        )
        self.name = name


class MissingSplitError(LoomsetError, FileNotFoundError):
    """A job needs the output of the prepare job and it is not there."""

    def __init__(self, directory: str):
        super().__init__(f"No finished splits in '{directory}'. Run the prepare job first.")
        self.directory = directory


class TooFewExamplesError(LoomsetError, ValueError):
    """Fewer rows than the configured minimum."""

    def __init__(self, stage: str, found: int, minimum: int):
        super().__init__(
            f"{found} examples {stage}, but at least {minimum} are required. Use a larger "
            f"dataset, raise max_seq_length or lower min_examples."
        )
        self.stage, self.found, self.minimum = stage, found, minimum


class EmptySplitError(LoomsetError, ValueError):
    """A split that the next job needs holds no row."""

    def __init__(self, sizes: dict[str, int]):
        listed = ", ".join(f"{name}={n}" for name, n in sizes.items())
        super().__init__(f"Empty split ({listed}). Run the prepare job again on more rows.")
        self.sizes = sizes


class DuplicateKeyError(LoomsetError, ValueError):
    """Two rows share the key that must identify a row."""


class SplitMismatchError(LoomsetError, RuntimeError):
    """What was written is not what was planned: the source changed between two reads."""


class AlignmentError(LoomsetError, ValueError):
    """Predictions and references do not pair up one to one."""
