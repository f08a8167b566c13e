"""Errors as data: which ones may be retried, the retry decision, backoff, and a circuit breaker per worker process."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

ERROR = "struct<type:string,message:string,failed_node:string,retryable:boolean>"
MAX_RETRIES, BACKOFF_BASE, BACKOFF_CAP = 3, 1.0, 30.0

#: Names of exceptions of optional libraries, besides the built-in ones below.
PERMANENT_NAMES = {"CircuitBreakerError"}
TRANSIENT_NAMES = {
    "TimeoutException", "ConnectTimeout", "ReadTimeout", "WriteTimeout", "PoolTimeout", "ConnectError", "ReadError", "RemoteProtocolError",
    "APITimeoutError", "APIError", "BotoCoreError", "ClientError", "OperationalError", "DBAPIError",
}


class BreakerOpen(Exception):
    """A call was refused, or a failure just opened the breaker; never retried."""


def classify(error: BaseException) -> bool:
    """Whether trying again may help. Permanent kinds are looked at first; unknown ones are permanent."""
    names = {c.__name__ for c in type(error).__mro__}
    if isinstance(error, (BreakerOpen, ValueError, TypeError, KeyError, NotImplementedError)) or names & PERMANENT_NAMES:
        return False
    return isinstance(error, (ConnectionError, TimeoutError)) or bool(names & TRANSIENT_NAMES)


def captured(error: BaseException, node: str) -> dict:
    return {"type": type(error).__name__, "message": str(error), "failed_node": node, "retryable": classify(error)}


def backoff(attempt: Column, base: float = BACKOFF_BASE, cap: float = BACKOFF_CAP) -> Column:
    """Seconds before an attempt, without jitter."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))


def jittered(seconds: Column) -> Column:
    """seconds times a factor in [0.5, 1)."""
    return seconds * (F.lit(0.5) + F.rand() / 2)


def may_retry(retryable: Column, count: Column, most: Column) -> Column:
    return F.coalesce(retryable & (count < most), F.lit(False))


def route(retryable: Column, count: Column, most: Column, failed_node: Column) -> Column:
    """The stage to go back to, or failure_handler."""
    return F.when(may_retry(retryable, count, most) & failed_node.isNotNull(), failed_node).otherwise("failure_handler")


@dataclass
class Breaker:
    """Opens after fail_max failures in a row and lets one call through after reset seconds. State is of this process."""

    name: str
    fail_max: int = 3
    reset: float = 60.0
    failures: int = 0
    opened: float | None = None
    clock: object = field(default=time.monotonic, repr=False)

    def call(self, fn, *args):
        if self.opened is not None and self.clock() - self.opened < self.reset:
            raise BreakerOpen(f"{self.name}: open")
        try:
            out = fn(*args)
        except Exception as e:
            self.failures += 1
            if self.failures >= self.fail_max or self.opened is not None:
                self.opened = self.clock()
                raise BreakerOpen(f"{self.name}: opened after {self.failures} failures") from e
            raise
        self.failures, self.opened = 0, None
        return out
