"""Column-expression builders (no UDFs)."""
from binyard.functions.semantics import *  # noqa: F401,F403
