"""What can go wrong in a run.  A run returns these, it does not raise them."""

from __future__ import annotations


class PipelineError(Exception):
    """A failed run: what happened, in which stage, and what is known about it."""

    def __init__(self, message: str, stage: str = "run", details: str | None = None):
        super().__init__(message if details is None else f"{message} ({details})")
        self.message, self.stage, self.details = message, stage, details


class CompilationError(PipelineError):
    """The document is no exported project."""

    def __init__(self, message: str, stage: str = "load", details: str | None = None, diagnostics: tuple[str, ...] = ()):
        super().__init__(message, stage, details)
        self.diagnostics = list(diagnostics)


class SettingsError(PipelineError):
    """A setting that is missing, or of the wrong kind."""

    def __init__(self, message: str, stage: str = "config", details: str | None = None):
        super().__init__(message, stage, details)


class StoreError(PipelineError):
    """The stored tables cannot be read, written, or updated in the way asked for."""

    def __init__(self, message: str, stage: str = "store", details: str | None = None):
        super().__init__(message, stage, details)


class DependencyError(PipelineError):
    """Something that is not bundled is missing or does not work: an encoder."""

    def __init__(self, message: str, stage: str = "dependency", details: str | None = None):
        super().__init__(message, stage, details)
