"""Errors of the sources, the store and the feature engine."""

from __future__ import annotations


class ClientError(Exception):
    """A request to the exchange failed."""


class ClientConnectionError(ClientError):
    """The exchange wasn't reached."""


class ClientTimeoutError(ClientError):
    """The exchange didn't answer in time."""


class ClientHttpError(ClientError):
    """An HTTP status that isn't a success."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


class ClientApiError(ClientHttpError):
    """An error that the exchange reports in its payload."""

    def __init__(self, message: str, code: int, status: int | None = None):
        super().__init__(message, status)
        self.code = code


class ClientResponseError(ClientError):
    """A payload that can't be understood."""


class StoreError(Exception):
    """A storage operation failed."""


class StoreInitError(StoreError):
    """The store can't be opened by this version."""


class StoreIntegrityError(StoreError):
    """A key exists already, or a parent row doesn't."""


class FeatureError(Exception):
    """The feature engine failed."""


class FeatureValidationError(FeatureError):
    """A candle or a sequence breaks a rule."""


class EmptySequenceError(FeatureValidationError):
    pass


class UnsortedSequenceError(FeatureValidationError):
    pass


class DuplicateTimestampError(FeatureValidationError):
    pass


class MalformedIntervalSpacingError(FeatureValidationError):
    pass


class FormingCandleError(FeatureValidationError):
    pass


class CorruptedCandleError(FeatureValidationError):
    pass


class CorruptedCandleValueError(FeatureValidationError):
    pass


class InvalidIntervalError(FeatureValidationError):
    pass


class InvalidTimestampError(FeatureValidationError):
    pass


class LookaheadViolationError(FeatureError):
    pass


class FeatureAssemblyError(FeatureError):
    pass
