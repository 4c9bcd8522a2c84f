"""The one exception type raised by gates and checks."""

from __future__ import annotations


class YearbookError(Exception):
    """Input or output broke a rule; the message names the rule and examples."""
