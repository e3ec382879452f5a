"""Errors raised by the package."""


class FragmentError(Exception):
    """Base class of the package's errors."""


class NotFragmentedError(FragmentError):
    """The table has no split of the requested kind."""


class AlreadyExistsError(FragmentError):
    """The table or split exists and replacing it was not asked for."""


class ConflictError(FragmentError):
    """Another writer changed the table or split in the meantime."""
