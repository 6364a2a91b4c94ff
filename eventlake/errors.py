"""Errors raised by the gates and readers."""


class EventLakeError(Exception):
    """Base class of every error raised by this package."""


class TableNotFoundError(EventLakeError):
    """A table path or name does not exist."""


class AmbiguousTableError(EventLakeError):
    """A partial table name fits more than one table."""


class DataQualityError(EventLakeError):
    """A data-quality rule was violated; ``violations`` maps rule to row count."""

    def __init__(self, violations: dict[str, int]):
        self.violations = violations
        listed = ", ".join(f"{rule}={count}" for rule, count in violations.items())
        super().__init__(f"data quality rules violated: {listed}")


class EmptyTableError(EventLakeError):
    """A table that must hold rows is empty."""


class SingleClassError(EventLakeError):
    """The training data holds one label only, so no classifier can be fitted."""


class ModelQualityError(EventLakeError):
    """The trained model has no metrics or stays under the accuracy threshold."""
