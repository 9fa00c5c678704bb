"""A stream that goes on after errors."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Failure:
    """One end by an error. ``batch``: the micro-batch that failed; ``attempt``: how often it
    has now, in a row; ``waited_s``: the wait before the next start."""

    batch: int
    attempt: int
    waited_s: float
    error: str


class GivenUp(RuntimeError):
    """The same micro-batch failed too often; ``failures`` has all that went before."""

    def __init__(self, failures: list[Failure]):
        super().__init__(f"micro-batch {failures[-1].batch} failed {failures[-1].attempt} times: {failures[-1].error}")
        self.failures = failures


def run_with_restarts(
    start: Callable[[], StreamingQuery],
    seconds: float | None = None,
    attempts: int = 5,
    wait_s: float = 1.0,
    longest_wait_s: float = 300.0,
    report: Callable[[Failure], None] | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> list[Failure]:
    """Run a query to its end, or for some time; after an error start it again from its
    checkpoint. Returns the failures it went on after.

    ``start`` starts the query with the same checkpoint each time. Waits double from
    ``wait_s`` on and are short again once a micro-batch succeeded. An error that ends the
    same micro-batch ``attempts`` times in a row is raised as ``GivenUp``: it will not go
    away by itself. Each failure goes to the log and to ``report`` when it happens.
    """
    until = None if seconds is None else time.monotonic() + seconds
    failures: list[Failure] = []
    while True:
        query = None
        try:
            query = start()
            if until is None:
                query.awaitTermination()
            elif not query.awaitTermination(max(0.1, until - time.monotonic())):
                query.stop()
            return failures
        except StreamingQueryException as error:
            done = query.lastProgress if query is not None else None
            batch = _failed_batch(done, failures)
            last = failures[-1] if failures else None
            attempt = last.attempt + 1 if last and last.batch == batch else 1
            wait = min(longest_wait_s, wait_s * 2 ** (attempt - 1))
            failure = Failure(batch, attempt, wait, _summary(error))
            failures.append(failure)
            log.warning("micro-batch %d failed (attempt %d): %s", batch, attempt, failure.error)
            if report:
                report(failure)
            if attempt >= attempts:
                raise GivenUp(failures) from error
            if until is not None and time.monotonic() + wait >= until:
                return failures
            sleep(wait)


def _failed_batch(progress, failures: list[Failure]) -> int:
    """The micro-batch after the last one that succeeded, in this run or an earlier one."""
    if progress is not None:
        return progress["batchId"] + 1
    return failures[-1].batch if failures else 0


def _summary(error: Exception) -> str:
    """The innermost message that says something, without stack traces."""
    lines = [x.strip() for x in str(error).splitlines()]
    told = [x for x in lines if x and not x.startswith(("at ", "File ", "JVM stacktrace", "Traceback"))]
    causes = [x for x in told if "Error: " in x or "Exception: " in x]
    return (causes or told or [type(error).__name__])[-1][:500]
