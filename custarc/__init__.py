"""custarc: customer-lifecycle analytics as lazy PySpark DataFrame functions."""

from custarc.settings import Settings

__all__ = ["Settings"]
