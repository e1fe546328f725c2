"""Retry with growing pauses."""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException


class Permanent(RuntimeError):
    """An error that trying again cannot mend."""


def with_retry(
    fn: Callable,
    initial: float = 1.0,
    max_interval: float = 30.0,
    max_elapsed: float = 300.0,
    sleep: Callable = time.sleep,
    clock: Callable = time.monotonic,
) -> Callable:
    """``fn`` that is called again after an error, until ``max_elapsed`` seconds have gone.

    Pauses grow by half from ``initial`` to ``max_interval``, give or take a
    half.  In the end the error is raised, which stops the query; nothing is
    lost, as a restart replays the batch.  What cannot succeed is raised at once:
    wrong arguments, batches at odds with the table, missing tables or columns.
    """

    def attempt(*args, **kwargs):
        began, pause = clock(), initial
        while True:
            try:
                return fn(*args, **kwargs)
            except (Permanent, ValueError, AnalysisException):
                raise
            except Exception:
                wait = pause * random.uniform(0.5, 1.5)
                if clock() - began + wait > max_elapsed:
                    raise
            sleep(wait)
            pause = min(pause * 1.5, max_interval)

    return attempt
