"""Calls to outside models: errors, back-off, throttling and retry. The rules are expressions; the loops run inside tasks."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.config import Settings


def error_class(code: Column, status: Column) -> Column:
    """The class of an error from its code and status; the first that fits, the status in any case."""
    c, s = F.coalesce(code.cast("string"), F.lit("")), F.upper(F.coalesce(status, F.lit("")))
    return (
        F.when((c == "429") | s.isin("RESOURCE_EXHAUSTED", "RATE_LIMIT_EXCEEDED"), "RATE_LIMIT")
        .when((c == "503") | s.isin("UNAVAILABLE", "TRY_AGAIN_LATER"), "UNAVAILABLE")
        .when((c == "400") | (s == "INVALID_ARGUMENT"), "BAD_REQUEST")
        .when((c == "404") | (s == "NOT_FOUND"), "NOT_FOUND")
        .when(c.startswith("5"), "SERVER_ERROR")
        .when(c.startswith("4"), "CLIENT_ERROR")
        .otherwise("UNKNOWN")
    )


def backoff_seconds(kind: Column, attempt: Column, base: float = 1.0, hinted: Column | None = None) -> Column:
    """Seconds to wait after a failed attempt (from 0): growing, by twice for an unavailable service; a rate limit's own hint
    goes first; requests that are wrong in themselves wait little."""
    grown = base * F.pow(F.when(kind == "UNAVAILABLE", 2.0).otherwise(1.5), F.greatest(attempt, F.lit(0)))
    if hinted is not None:
        grown = F.when((kind == "RATE_LIMIT") & hinted.isNotNull(), hinted).otherwise(grown)
    return F.when(kind.isin("BAD_REQUEST", "NOT_FOUND"), F.least(grown, F.lit(0.8))).otherwise(grown)


def switches_model(kind: Column, attempt: Column, models: Column) -> Column:
    """Whether the next attempt asks another model."""
    busy = kind.isin("RATE_LIMIT", "UNAVAILABLE") & (attempt % 2 == 1)
    other = kind.isin("SERVER_ERROR", "UNKNOWN", "CLIENT_ERROR") & (attempt % 3 == 2)
    return (models > 1) & (busy | other)


def retry_delay(hint: Column) -> Column:
    """Seconds of a retry hint: "3s", "250ms", a bare number, or a JSON object of seconds and nanos; null if unreadable."""
    s = F.lower(F.trim(hint))
    parts = F.from_json(hint, "seconds double, nanos double")
    number = r"^[+-]?(\d+\.?\d*|\.\d+)$"
    return (
        F.when(s.startswith("{"), F.coalesce(parts["seconds"], F.lit(0.0)) + F.coalesce(parts["nanos"], F.lit(0.0)) / 1e9)
        .when(s.endswith("ms"), F.when(F.regexp_replace(s, "ms$", "").rlike(number), F.regexp_replace(s, "ms$", "").try_cast("double") / 1000.0))
        .when(s.endswith("s"), F.when(F.regexp_replace(s, "s$", "").rlike(number), F.regexp_replace(s, "s$", "").try_cast("double")))
        .when(s.rlike(number), s.try_cast("double"))
    )


class Limiter:
    """Spaces calls by the allowed rate, shared out over the tasks that run at once; penalties slow it down, up to a cap."""

    def __init__(self, rpm: float, floor: float = 2.0, slowdown: float = 1.4, tasks: int = 1, cap: float = 8.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rpm, self.floor, self.slow, self.tasks, self.cap = rpm, floor, slowdown, tasks, cap
        self.clock, self.sleep, self.next_at = clock, sleep, 0.0

    @property
    def gap(self) -> float:
        return 60.0 / max(self.rpm, self.floor) * self.slow * self.tasks

    def wait(self) -> None:
        now = self.clock()
        if now < self.next_at:
            self.sleep(self.next_at - now)
        self.next_at = max(now, self.next_at) + self.gap

    def penalize(self) -> None:
        self.slow = min(self.cap, self.slow * 1.2)


class TokenBucket:
    """Tokens that refill with time; a penalty halves what it holds at most, down to one."""

    def __init__(self, capacity: float, per_second: float, clock: Callable[[], float] = time.monotonic):
        self.capacity, self.per_second, self.clock = capacity, per_second, clock
        self.tokens, self.at = capacity, clock()

    def take(self, n: float = 1.0) -> bool:
        now = self.clock()
        self.tokens = min(self.capacity, self.tokens + (now - self.at) * self.per_second)
        self.at = now
        if self.tokens < n:
            return False
        self.tokens -= n
        return True

    def penalize(self) -> None:
        self.capacity = max(1.0, self.capacity / 2)
        self.tokens = min(self.tokens, self.capacity)


@dataclass
class Outcome:
    ok: bool
    value: object = None
    attempts: int = 0
    model: int = 0
    errors: list[str] = field(default_factory=list)


def classify(code: object, status: str | None) -> str:
    """As error_class, for one error."""
    c, s = "" if code is None else str(code), (status or "").upper()
    if c == "429" or s in ("RESOURCE_EXHAUSTED", "RATE_LIMIT_EXCEEDED"):
        return "RATE_LIMIT"
    if c == "503" or s in ("UNAVAILABLE", "TRY_AGAIN_LATER"):
        return "UNAVAILABLE"
    if c == "400" or s == "INVALID_ARGUMENT":
        return "BAD_REQUEST"
    if c == "404" or s == "NOT_FOUND":
        return "NOT_FOUND"
    return "SERVER_ERROR" if c.startswith("5") else "CLIENT_ERROR" if c.startswith("4") else "UNKNOWN"


def call_with_retry(call: Callable[[int], object], settings: Settings, limiter: Limiter, models: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] | None = None) -> Outcome:
    """call(model) until it answers, the attempts or the time run out. Errors that retrying can't mend end it at once.

    An error may carry code, status and retry_seconds. Interrupts are not errors and pass through.
    """
    jitter = jitter or (lambda: random.uniform(0, settings.jitter_sec))
    began, model, out = clock(), 0, Outcome(False)
    for attempt in range(settings.max_retries + 1):
        if clock() - began >= settings.retry_budget_sec:
            break
        limiter.wait()
        out.attempts, out.model = attempt + 1, model
        try:
            out.value, out.ok = call(model), True
            return out
        except Exception as e:  # noqa: BLE001
            kind = classify(getattr(e, "code", None), getattr(e, "status", None))
            out.errors.append(kind)
            if kind in ("BAD_REQUEST", "NOT_FOUND"):
                break
            wait = settings.base_backoff_sec * (2.0 if kind == "UNAVAILABLE" else 1.5) ** attempt
            if kind == "RATE_LIMIT" and getattr(e, "retry_seconds", None) is not None:
                wait = float(e.retry_seconds)  # type: ignore[attr-defined]
            if kind in ("RATE_LIMIT", "UNAVAILABLE"):
                limiter.penalize()
                model = (model + 1) % models if attempt % 2 == 1 else model
            else:
                model = (model + 1) % models if attempt % 3 == 2 else model
            sleep(min(wait + jitter(), max(0.0, settings.retry_budget_sec - (clock() - began))))
    return out


def rpm_of(settings: Settings, operation: str) -> int:
    """Requests a minute of an operation: the overall rate if it is above zero, else the operation's own."""
    return settings.rpm if settings.rpm > 0 else int(getattr(settings, f"rpm_{operation}", settings.rpm_floor))


def policy_of(settings: Settings, operation: str) -> Settings:
    """The settings with the operation's own attempts and time: headers have theirs."""
    if operation == "header":
        return replace(settings, max_retries=settings.header_max_retries, retry_budget_sec=settings.header_retry_budget_sec)
    return settings


def limiter_of(settings: Settings, operation: str, tasks: int = 1, bucket: TokenBucket | None = None, sleep: Callable[[float], None] = time.sleep) -> Limiter:
    """The limiter of an operation's calls, over a bucket if one is given."""
    made = Limiter(rpm_of(settings, operation), settings.rpm_floor, settings.slowdown, tasks, sleep=sleep)
    return made if bucket is None else BucketLimiter(made, bucket)


class BucketLimiter(Limiter):
    """A limiter that takes its calls from a bucket, and waits while that is empty."""

    def __init__(self, paced: Limiter, bucket: TokenBucket):
        super().__init__(paced.rpm, paced.floor, paced.slow, paced.tasks, paced.cap, paced.clock, paced.sleep)
        self.bucket = bucket

    def wait(self) -> None:
        while not self.bucket.take():
            self.sleep(1.0 / self.bucket.per_second)

    def penalize(self) -> None:
        self.bucket.penalize()


def batched(ask: Callable[[int, list[dict]], list], settings: Settings, operation: str, batch: int, answer: str = "int", tasks: int | None = None, models: int = 1, sleep: Callable[[float], None] = time.sleep):
    """A decider: DataFrame of questions (key, ...) -> (key, decision), asked in batches inside the tasks, with retry and throttling.

    ask(model, rows of a batch) -> one answer a row; a short answer leaves the rest null, and so does a call that is given up.
    The rate is shared out over `tasks` partitions, into which the questions are put (by default the cluster's parallelism).
    """
    policy = policy_of(settings, operation)

    def decide(questions: DataFrame) -> DataFrame:
        n = tasks or questions.sparkSession.sparkContext.defaultParallelism

        def run(batches):
            limiter = limiter_of(settings, operation, n, sleep=sleep)
            for b in batches:
                for a in range(0, b.num_rows, batch):
                    part = b.slice(a, batch)
                    rows = part.to_pylist()
                    out = call_with_retry(lambda model: ask(model, rows), policy, limiter, models, sleep=sleep)
                    got = list(out.value)[: len(rows)] if out.ok and out.value is not None else []
                    kind = pa.int32() if answer == "int" else pa.string()
                    yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(got + [None] * (len(rows) - len(got)), kind)], names=["key", "decision"])

        return questions.repartition(n, "key").mapInArrow(run, f"key string, decision {answer}")

    return decide
