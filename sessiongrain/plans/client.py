"""Around the injected model function: pool, back-off, structured retry, context limits and feedback, as data.

Requests and answers are rows. Each task owns one Caller for all its rows: an unavailable service delays the request that
met it while others go on, and failures in a row, whichever requests they meet, stop them all. Time is a parameter:
without a function that waits, a clock of its own jumps ahead, so schedules can be run without sleeping.
"""

from __future__ import annotations

import difflib
import heapq
import json
import re
import time
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessiongrain.plans.judge import Judge

# Seconds before each further try while a service is unavailable, failures in a row that open the circuit, seconds it stays open.
WAITS = (15, 45, 120)
OPEN_AFTER = 5
COOLDOWN = 180


class Unavailable(Exception):
    """The service says that it cannot answer now (HTTP 503)."""


class TooLong(Exception):
    """The request and the asked-for answer exceed the model's context."""


@dataclass
class Caller:
    """Sends requests to the clients in turn. After OPEN_AFTER failures in a row it waits COOLDOWN seconds and probes once."""

    clients: list[Judge]
    wait: Callable[[float], None] | None = None
    failures: int = 0
    turn: int = 0
    waited: list[float] = field(default_factory=list)

    def _pause(self, seconds: float) -> None:
        self.waited.append(seconds)
        if self.wait is not None:
            self.wait(seconds)

    def send(self, system: str, user: str) -> tuple[dict, dict]:
        for step in range(len(WAITS) + 1):
            if self.failures >= OPEN_AFTER:
                self._pause(COOLDOWN)
            client = self.clients[self.turn % len(self.clients)]
            self.turn += 1
            try:
                answer = client(system, user)
                self.failures = 0
                return answer
            except Unavailable:
                self.failures += 1
                if step == len(WAITS):
                    raise
                if self.failures < OPEN_AFTER:
                    self._pause(WAITS[step])
        raise AssertionError("unreachable")

    def answers(self, system: str, dialogues: Iterator[tuple[object, Dialogue]]) -> Iterator[tuple[object, dict, float]]:
        """(key, result, seconds that its own retries were put off) of every dialogue, as they end.

        Retries that are due come before new requests, so those under way are few at any time. After OPEN_AFTER failures in a
        row nothing is sent for COOLDOWN seconds; then one request probes, and its failure starts another pause.
        """
        began, ahead = time.monotonic(), 0.0
        now = lambda: ahead + (time.monotonic() - began if self.wait is not None else 0.0)
        due: list[tuple[float, int, _Request]] = []
        open_until, order = 0.0, 0

        def pause(until: float) -> None:
            nonlocal ahead
            seconds = until - now()
            if seconds > 0:
                self.waited.append(seconds)
                if self.wait is None:
                    ahead += seconds
                else:
                    self.wait(seconds)

        while True:
            pause(open_until)
            if due and due[0][0] <= now():
                request = heapq.heappop(due)[2]
            elif (new := next(dialogues, None)) is not None:
                request = _Request(new[0], new[1], next(new[1]))
            elif due:
                pause(due[0][0])
                continue
            else:
                return
            outcome: dict | Exception
            self.turn += 1
            try:
                outcome = self.clients[(self.turn - 1) % len(self.clients)](system, request.prompt)[0]
                self.failures = 0
            except TooLong as error:
                outcome, self.failures = error, 0
            except Unavailable as error:
                outcome, self.failures = error, self.failures + 1
                request.failures += 1
                if self.failures >= OPEN_AFTER:
                    open_until = now() + COOLDOWN
                if request.failures <= len(WAITS):
                    delay = WAITS[request.failures - 1]
                    request.waited, order = request.waited + delay, order + 1
                    heapq.heappush(due, (now() + delay, order, request))
                    continue
            try:
                request.prompt = request.dialogue.throw(outcome) if isinstance(outcome, Exception) else request.dialogue.send(outcome)
                request.failures, order = 0, order + 1
                heapq.heappush(due, (now(), order, request))
            except StopIteration as end:
                yield request.key, end.value, request.waited


#: Yields prompts, is sent answers (or thrown TooLong and Unavailable), and returns the result.
Dialogue = Generator[str, dict, dict]


@dataclass
class _Request:
    key: object
    dialogue: Dialogue
    prompt: str
    failures: int = 0
    waited: float = 0.0


def feedback(error: str, quote: str | None = None, source: str | None = None, room: int = 80) -> str:
    """What a model is told about its last answer: the error, and for a wrong citation the closest passage of the source."""
    if not quote or not source:
        return error
    m = difflib.SequenceMatcher(a=source, b=quote, autojunk=False).find_longest_match()
    return f"{error}; closest passage: {source[max(0, m.a - room) : m.a + m.size + room]}" if m.size else f"{error}; nothing of it is in the source"


def repaired_keys(value: dict, known: tuple[str, ...]) -> dict:
    """value with misspelt keys put right where exactly one known key is close and not there."""
    out = {}
    for k, v in value.items():
        close = difflib.get_close_matches(k, [x for x in known if x not in value], 2, 0.85) if k not in known else []
        out[close[0] if len(close) == 1 else k] = v
    return out


#: What a check says of an answer: nothing, an error, or an error with the quote that is wrong and the source that it should stand in.
Verdict = str | tuple[str, str, str] | None


def dialogue(user: str, check: Callable[[dict], Verdict], known: tuple[str, ...] = (), attempts: int = 4, budget: int = 8192, least: int = 512) -> Dialogue:
    """One request until it has a valid answer: invalid answers go back with feedback, too long ones ask for half the budget."""
    told, error, tries = user, None, 0
    while tries < attempts:
        tries += 1
        try:
            value = yield f"{told}\n[most output tokens: {budget}]"
        except TooLong:
            error = "context limit"
            if budget // 2 < least:
                break
            budget //= 2
            continue
        except Unavailable:
            return {"answer": None, "error": "service unavailable", "attempts": tries, "budget": budget}
        value = repaired_keys(value, known)
        verdict = check(value)
        if verdict is None:
            return {"answer": value, "error": None, "attempts": tries, "budget": budget}
        parts = (verdict,) if isinstance(verdict, str) else verdict
        error = parts[0]
        told = f"{user}\nYour last answer was not valid: {feedback(*parts)}"
    return {"answer": None, "error": error, "attempts": tries, "budget": budget}


def ask(caller: Caller, system: str, user: str, check: Callable[[dict], Verdict], known: tuple[str, ...] = (), attempts: int = 4, budget: int = 8192, least: int = 512) -> dict:
    """Answer, error, attempts and the output budget that fitted, of one request (see dialogue)."""
    return next(caller.answers(system, iter([(None, dialogue(user, check, known, attempts, budget, least))])))[1]


def ask_rows(
    requests: DataFrame, clients: list[Judge], system: str, check: Callable[[dict], Verdict], id_col: str, prompt: str = "prompt", known: tuple[str, ...] = (), attempts: int = 4,
    wait: Callable[[float], None] | None = None,
) -> DataFrame:
    """(id, answer JSON, error, attempts, budget, waited): every request gives one row, answered or not; waited are the seconds of its own retries.

    The rows of a task share one Caller, its circuit and its pool; tasks begin with different clients. wait: time.sleep, or None for no sleeping.
    """
    kind = requests.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        caller = Caller(clients, wait, turn=task.partitionId() if task else 0)
        rows = ((name, dialogue(text, check, known, attempts)) for pdf in batches for name, text in zip(pdf[id_col], pdf[prompt], strict=True))
        out = []
        for name, got, waited in caller.answers(system, rows):
            answer = None if got["answer"] is None else json.dumps(got["answer"], ensure_ascii=False, sort_keys=True)
            out.append((name, answer, got["error"], got["attempts"], got["budget"], float(waited)))
            if len(out) == 1000:
                yield pd.DataFrame(out, columns=[id_col, "answer", "error", "attempts", "budget", "waited"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=[id_col, "answer", "error", "attempts", "budget", "waited"])

    return requests.select(id_col, prompt).mapInPandas(run, f"{id_col} {kind}, answer string, error string, attempts int, budget int, waited double")


def exact_locators(citations: DataFrame, events: DataFrame, event: str = "event_id", quote: str = "quote", text: str = "text") -> DataFrame:
    """Citations with the start of their quote in the cited event, only where it stands there exactly once: else null."""
    both = citations.join(events.select(event, F.col(text).alias("__t")), event, "left")
    at = F.instr("__t", F.col(quote))
    again = F.call_function("locate", F.col(quote), F.col("__t"), at + 1)
    return both.withColumn("start", F.when((at > 0) & (again == 0), at - 1)).drop("__t")


def path_indexes(path: str, ids: list[str]) -> str:
    """A field path with list ids in brackets -> indexes, where an id stands once in the list; otherwise unchanged."""
    place = lambda m: f"[{ids.index(m[1])}]" if ids.count(m[1]) == 1 else m[0]
    return re.sub(r"\[([A-Za-z_][\w-]*)\]", place, path)
