"""Stream-only forms: keyed state with event-time timers."""

from tidehouse.streaming import stateful  # noqa: F401
