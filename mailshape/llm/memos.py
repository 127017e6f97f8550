"""One word memo at a time in a Python worker."""

from __future__ import annotations

_held: list = []


def alone(memo):
    """``memo``, after emptying the one that an earlier stage's operator left in this worker: workers
    are used again from stage to stage, and the memos of a whole pipeline would add up."""
    if not _held or _held[0] is not memo:
        if _held:
            _held[0].clear()
        _held[:] = [memo]
    return memo
