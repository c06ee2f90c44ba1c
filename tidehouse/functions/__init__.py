"""Column functions shared by the operators."""

from tidehouse.functions import mapfns, textfns, timefns  # noqa: F401
