"""One call of an external summary service per article, with retries and a second model.

The service is any picklable ``factory`` that returns a function ``invoke(Request) -> str``. It is built
once per task, where it may open clients. ``invoke`` reports a service failure by raising
``ServiceError(code, message)``.

A task that is retried calls the service again for its rows. Write the article table with its
summaries before using it twice (``session.materialize``), and pass stored summaries to
``summarize_articles`` so that known prompts are not sent again.
"""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import prompts
from .summary_store import SummaryStore, attach_table

# --- fixed values -----------------------------------------------------------------------------
RETRYABLE_CODES = ("ThrottlingException", "ServiceUnavailableException", "TooManyRequestsException")
SWITCH_MODEL_CODE = "ValidationException"
SWITCH_MODEL_TEXT = "on-demand throughput"
DEFAULT_MAX_RETRIES = 3
# ----------------------------------------------------------------------------------------------
EMPTY_RESPONSE = "EmptyResponse"

OUTCOME = T.StructType(
    [
        T.StructField("summary", T.StringType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("model_used", T.StringType()),
        T.StructField("elapsed_ms", T.DoubleType()),
        T.StructField("throttled", T.LongType()),
        T.StructField("waited_ms", T.DoubleType()),
    ]
)
_ARROW_TYPES = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64()}


class ServiceError(Exception):
    def __init__(self, code: str, message: str = ""):
        super().__init__(f"{code}: {message}")
        self.code = code
        self.message = message


class Request(NamedTuple):
    text: str
    model: str
    max_words: int
    max_tokens: int


class Outcome(NamedTuple):
    summary: str | None
    attempts: int
    error_code: str | None
    model_used: str | None


Invoke = Callable[[Request], str]


@dataclass(frozen=True)
class CallPolicy:
    """``jitter`` lengthens each wait by a random part of up to that fraction, so that tasks throttled together do not come
    back together. ``adaptive`` lets each task find out how many open calls the service bears (see ``OpenCalls``).
    ``max_throttled`` throttled answers per article do not count as attempts: each waits a second for the next."""

    model: str = "primary"
    fallback_model: str | None = "fallback"
    max_words: int = prompts.DEFAULT_MAX_WORDS
    max_retries: int = DEFAULT_MAX_RETRIES
    sleep: Callable[[float], None] = time.sleep
    jitter: float = 0.0
    adaptive: bool = False
    max_throttled: int = 0

    def wait(self, seconds: float) -> None:
        self.sleep(seconds * (1 + self.jitter * random.random()))

    def request(self, text: str, model: str | None = None) -> Request:
        return Request(text, model or self.model, self.max_words, prompts.max_tokens(self.max_words))


def call_service(invoke: Invoke, text: str, policy: CallPolicy) -> Outcome:
    """Call until there is text, the error is final, or the attempts are used up. Never raises."""
    error, attempt, spared = EMPTY_RESPONSE, 0, policy.max_throttled
    while attempt < policy.max_retries:
        attempt += 1
        try:
            summary = invoke(policy.request(text)).strip()
        except ServiceError as exc:
            error = exc.code
            if error == SWITCH_MODEL_CODE and SWITCH_MODEL_TEXT in exc.message and policy.fallback_model:
                return _call_second_model(invoke, text, policy, attempt)
            if error not in RETRYABLE_CODES:
                return Outcome(None, attempt, error, None)
            if spared:
                spared, attempt = spared - 1, attempt - 1
                policy.wait(1)
                continue
        except Exception as exc:  # one bad article must not fail its task
            error = type(exc).__name__
        else:
            if summary:
                return Outcome(summary, attempt, None, policy.model)
            error = EMPTY_RESPONSE
            continue  # an empty answer is asked again at once
        if attempt < policy.max_retries:
            policy.wait(2 ** (attempt - 1))
    return Outcome(None, policy.max_retries, error, None)


def _call_second_model(invoke: Invoke, text: str, policy: CallPolicy, attempt: int) -> Outcome:
    try:
        summary = invoke(policy.request(text, policy.fallback_model)).strip()
    except Exception as exc:
        return Outcome(None, attempt, getattr(exc, "code", type(exc).__name__), None)
    return Outcome(summary or None, attempt, None if summary else EMPTY_RESPONSE, policy.fallback_model)


class OpenCalls:
    """How many calls of a task may be open: one more after each round of answers, half as many after a throttled one.

    Starts with one and never exceeds ``most``. Calls that were open when the limit was halved do not halve it again. Turns
    are given in the order of asking, so a call waits for those of fewer than ``most`` other threads. A call that
    sleeps before its next attempt is not open.
    """

    def __init__(self, most: int):
        self.most, self.limit, self.open = most, 1.0, 0
        self._asked = self._started = self._halved_at = 0
        self._turn = threading.Condition()

    def enter(self) -> int:
        with self._turn:
            mine, self._asked = self._asked, self._asked + 1
            self._turn.wait_for(lambda: self._started == mine and self.open < int(self.limit))
            self.open += 1
            self._started += 1
            self._turn.notify_all()
            return mine

    def leave(self, number: int, throttled: bool) -> None:
        with self._turn:
            self.open -= 1
            if not throttled:
                self.limit = min(self.most, self.limit + 1 / self.limit)
            elif number >= self._halved_at:
                self.limit, self._halved_at = max(1.0, self.limit / 2), self._started
            self._turn.notify_all()


class _Watched:
    """A service for one article: its calls take turns, and throttled answers and waits for a turn are counted."""

    def __init__(self, invoke: Invoke, calls: OpenCalls | None):
        self.invoke, self.calls, self.throttled, self.waited = invoke, calls, 0, 0.0

    def __call__(self, request: Request) -> str:
        asked = time.perf_counter()
        number = self.calls.enter() if self.calls else 0
        self.waited += time.perf_counter() - asked if self.calls else 0
        throttled = False
        try:
            return self.invoke(request)
        except ServiceError as exc:
            throttled = exc.code in RETRYABLE_CODES
            raise
        finally:
            self.throttled += throttled
            if self.calls:
                self.calls.leave(number, throttled)


def call_column(text: Column, factory: Callable[[], Invoke], policy: CallPolicy, calls_per_task: int = 1) -> Column:
    """Struct column with the outcome of one call per row; no call where ``text`` is NULL.

    ``calls_per_task`` calls of a task wait for the service at one time, with an adaptive policy at most so many; ``invoke``
    must then be thread-safe. ``elapsed_ms`` leaves out ``waited_ms``, the wait for a turn. Only ``text`` travels to Python. The function counts as nondeterministic, so the optimizer
    neither repeats it nor moves filters past it. A batch of texts stays as Arrow sends it; with one call at a time one text
    at a time becomes a Python string.
    """

    def summarize(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        invoke, calls = factory(), OpenCalls(calls_per_task) if policy.adaptive else None

        def one(t: str | None) -> tuple:
            if t is None:
                return None, 0, None, None, None, 0, None
            started, watched = time.perf_counter(), _Watched(invoke, calls)
            outcome = call_service(watched, t, policy)
            elapsed = time.perf_counter() - started - watched.waited
            return *outcome, elapsed * 1e3, watched.throttled, watched.waited * 1e3

        with ThreadPoolExecutor(calls_per_task) as pool:
            for batch in batches:
                texts = (t.as_py() for t in batch)
                rows = list(pool.map(one, texts) if calls_per_task > 1 else map(one, texts))
                columns = [pa.array([row[k] for row in rows], _ARROW_TYPES[f.dataType]) for k, f in enumerate(OUTCOME)]
                yield pa.StructArray.from_arrays(columns, OUTCOME.names)

    return F.arrow_udf(summarize, OUTCOME).asNondeterministic()(text)


def default_text(policy: CallPolicy) -> Column:
    """What the service gets of a cleaned article: the article prompt, NULL for a blank body."""
    return prompts.article_prompt(
        F.col("primary_ticker"), F.col("title"), F.col("body_clean"), F.col("teaser_clean"), policy.max_words
    )


def summarize_articles(
    cleaned: DataFrame,
    factory: Callable[[], Invoke],
    policy: CallPolicy | None = None,
    *,
    text: Column | None = None,
    max_concurrent_calls: int | None = None,
    calls_per_task: int = 1,
    stored: DataFrame | SummaryStore | None = None,
    columns: tuple[str, ...] | None = None,
    read_again: bool = False,
) -> DataFrame:
    """Add ``summary``, ``prompt_hash`` and the columns of ``OUTCOME`` to cleaned articles.

    A blank body makes no call; its summary is the teaser, or NULL. ``text`` is what the service gets,
    by default the article prompt. ``max_concurrent_calls`` spreads the rows evenly over that many
    partitions, which is the number of calls that can run at one time, and of files a write without
    rotation makes per window; ``calls_per_task`` multiplies them without more partitions. ``stored`` (see
    ``summary_store``) holds earlier results; a match is used instead of a call. A table is joined as it is, a ``SummaryStore`` of
    any size stays where it is. ``columns`` are those of the articles
    that go on (by default all): name them, or the spreading and the match shuffle HTML and cleaned texts as well. ``read_again`` says that ``cleaned`` is a stored
    table: then a table of earlier results is matched without shuffling the texts (see ``summary_store.attach_table``).
    """
    policy = policy or CallPolicy()
    if text is None:
        text = default_text(policy)
    columns = columns or tuple(cleaned.columns)
    teaser = F.when(text.isNull(), F.nullif("teaser_clean", F.lit("")))
    articles = cleaned.select(*columns, text.alias("_text"), teaser.alias("_teaser"))
    articles = articles.withColumn("prompt_hash", F.sha2("_text", 256))
    if isinstance(stored, SummaryStore):
        articles = stored.attach(articles)
    elif stored is not None and read_again:
        articles = attach_table(articles, stored)
    elif stored is not None:
        known = stored.select(F.col("news_id").alias("id"), "prompt_hash", F.col("summary").alias("_known"))
        articles = articles.join(known, ["id", "prompt_hash"], "left")
    else:
        articles = articles.withColumn("_known", F.lit(None).cast("string"))
    if max_concurrent_calls:
        articles = articles.repartition(max_concurrent_calls)
    called = articles.withColumn("_out", call_column(F.when(F.col("_known").isNull(), F.col("_text")), factory, policy, calls_per_task))
    return called.select(
        *columns,
        "prompt_hash",
        F.coalesce("_known", "_out.summary", "_teaser").alias("summary"),
        F.coalesce(F.col("_out.attempts"), F.lit(0)).alias("attempts"),
        "_out.error_code",
        "_out.model_used",
        "_out.elapsed_ms",
        F.coalesce(F.col("_out.throttled"), F.lit(0)).alias("throttled"),
        "_out.waited_ms",
    )


def summarize_html(
    articles: DataFrame, factory: Callable[[], Invoke], policy: CallPolicy | None = None, **options
) -> DataFrame:
    """As ``summarize_articles`` on the raw HTML body, without the teaser; blank HTML gives NULL."""
    policy = policy or CallPolicy()
    prompt = options.pop("text", None)
    if prompt is None:
        prompt = prompts.html_prompt(F.col("primary_ticker"), F.col("title"), F.col("body"), policy.max_words)
    without_teaser = articles.drop("teaser_clean").withColumn("teaser_clean", F.lit(None).cast("string"))
    return summarize_articles(without_teaser, factory, policy, text=prompt, **options).drop("teaser_clean")


def summary_store(summarized: DataFrame) -> DataFrame:
    """Rows to keep for reuse: one summary per article and prompt, from calls and not from reuse.

    Pass the stored form of the summarized articles (``session.materialize``), or they are called again.
    """
    made = summarized.where(F.col("summary").isNotNull() & (F.col("attempts") > 0))
    return made.groupBy(F.col("id").alias("news_id"), "prompt_hash").agg(F.min("summary").alias("summary"))


class LeadingSentences:
    """Stand-in service without a network: the first words of the text, up to the last sentence end.

    Gets the cleaned body as ``text`` (not a prompt) and keeps at most ``max_words`` words.
    """

    def __call__(self) -> Invoke:
        return self.invoke

    @staticmethod
    def invoke(request: Request) -> str:
        found = request.text.split()
        lead = found[: request.max_words]
        if len(found) > len(lead):
            ends = [i for i, word in enumerate(lead, 1) if word.endswith((".", "!", "?"))]
            lead = lead[: ends[-1]] if ends else lead
        return " ".join(lead)
