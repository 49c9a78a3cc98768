"""Streaming changes into a keyed copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.serving import ServingCopy
from millrace.streaming.runs import keep_running, run_to_end, to_batches


def sync_continuous(
    changes: DataFrame,
    copy: ServingCopy,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Upsert a stream of changes; batches may repeat and come out of order.

    A batch costs as much as it brings, however large the copy is.  The copy is
    kept short by ``maintain``, a job of its own.  With ``every`` the query goes
    on looking for changes at that interval; without, it works off what is
    there and ends.
    """
    writer = to_batches(changes, copy.append_changes, checkpoint)
    return keep_running(writer, every) if every else run_to_end(writer)


def maintain(copy: ServingCopy, keep: int = 2, forget_before: int | None = None) -> bool:
    """Fold the changes so far into a new version and delete what is older than
    the newest ``keep`` versions; may run beside the stream.  Returns whether
    there was anything to fold."""
    folded = copy.fold(forget_before)
    copy.expire(keep)
    return folded
