"""Parameter guards (P17), raised while the plan is built, before any job."""

from __future__ import annotations


def require_top_n(n: int) -> None:
    if not isinstance(n, int) or n < 1:
        raise ValueError(f"a ranking needs a positive size, got {n!r}")


def require_emit_seconds(seconds: int) -> None:
    if not isinstance(seconds, int) or seconds < 1:
        raise ValueError(f"emit every whole second or more, got {seconds!r}")


def require_slots(n: int) -> None:
    if not isinstance(n, int) or n < 1:
        raise ValueError(f"a counter needs one slot or more, got {n!r}")


def require_window_slots(n: int) -> None:
    if not isinstance(n, int) or n < 2:
        raise ValueError(f"a sliding window needs two slots or more, got {n!r}")


def require_tracked(n: int) -> None:
    if not isinstance(n, int) or n < 1:
        raise ValueError(f"track one mark or more, got {n!r}")
