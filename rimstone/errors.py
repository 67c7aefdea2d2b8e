"""Errors a caller may want to tell apart."""


class LakeError(Exception):
    """Base of every error raised by this package."""


class MissingColumn(LakeError):
    """A table lacks a column an operation needs."""


class EmptyDataset(LakeError):
    """A dataset or key list that must hold rows is empty."""


class MissingSuffix(LakeError):
    """A source name was asked for without suffixes."""


class ContractBroken(LakeError):
    """A table's columns or types differ from its declared contract."""


class ChecksFailed(LakeError):
    """At least one check of severity `error` found failing rows."""


class BudgetExceeded(LakeError):
    """More keys failed than a source may lose."""


class LayoutFault(LakeError):
    """A report file cannot be laid out as table rows."""
