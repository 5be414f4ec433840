"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from bazaar.functions.scalar import *  # noqa: F401,F403
from bazaar.functions.scalar import __all__  # noqa: F401
