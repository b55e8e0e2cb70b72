"""The registered queries; whichever module is imported first, the registry imports all of them in its order."""

from lakeops import registry  # noqa: F401
