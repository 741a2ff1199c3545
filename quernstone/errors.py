"""Error classes raised by the engine; all derive from :class:`EngineError`."""


class EngineError(Exception):
    """Base of every error that the engine raises on purpose."""


class FetchError(EngineError):
    """A source file could not be staged."""


class ParseError(EngineError):
    """A document or row does not have the expected form."""


class TransformError(EngineError):
    """A transform met data that it must not pass on."""


class ValidationError(EngineError):
    """Rows break their schema."""


class DedupError(EngineError):
    """Rows of one identifier disagree, or a policy is unknown."""


class DeliveryError(EngineError):
    """Output could not be handed over."""


class RegistryError(EngineError):
    """The source registry is inconsistent."""
