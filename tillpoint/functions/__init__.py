"""Scalar column functions (native Spark expressions, no Python UDFs)."""

from tillpoint.functions.scalars import *  # noqa: F401,F403
