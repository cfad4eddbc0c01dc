"""Column expressions."""
from tidewright.functions.expr import *  # noqa: F401,F403
