"""Ports: what leaves the engine. Only the stubs are here; a deployment brings its own."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.threads import verdict_of

Completer = Callable[[str], str]
RETRYABLE = frozenset({408, 425, 429, 500, 502, 503, 504})


def stub_answer(prompt: str) -> str:
    """A deterministic answer to an enrichment prompt."""
    direction = "FYI_ONLY" if "Thread direction: Outbound" in prompt else "REPLY_NEEDED"
    texts = dict.fromkeys(("company_intel", "pipeline_signals", "brain_notes", "personal_notes_extract", "topics_of_interest_extract", "conversation_trigger_extract"), "")
    return json.dumps(texts | {"running_summary": f"{len(prompt)} characters", "key_commitments": "", "personal_details_flag": False, "action_required": direction, "outcome": "Neutral", "response_draft": "stub", "tasks": [], "ready_to_archive": False})


def stub(prompt: str) -> str:
    """A deterministic answer: the score is the prompt's length modulo 101."""
    return json.dumps({"score": len(prompt) * 7 % 101, "reason": "stub"})


class Refused(Exception):
    """A remote side answered with a status that is no success; 0: the network failed."""

    def __init__(self, status: int, detail: str = ""):
        super().__init__(f"{status} {detail}".strip())
        self.status = status


def retry_delay(attempt: int, status: int, base: float = 1.0) -> float | None:
    """Seconds before the try after the ``attempt``-th (from 1), doubling, five after 429; None where a status isn't retried."""
    if status and status not in RETRYABLE:
        return None
    return 5.0 if status == 429 else base * 2 ** (attempt - 1)


def retried(call: Callable[[], str], attempts: int = 3, base: float = 1.0, pause: Callable[[float], None] = time.sleep) -> str:
    """The call's answer; refusals worth it are tried again after a pause, the last one is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Refused as e:
            delay = retry_delay(attempt, e.status, base)
            if delay is None or attempt == attempts:
                raise
            pause(delay)
    raise ValueError("attempts must be at least 1")


def answered(rows: DataFrame, key: str, prompt: str, completer: Completer) -> DataFrame:
    """(key, answer): one call a row, after all filters; a failed call's answer says so and fits no schema."""

    def run(batches):
        for b in batches:
            answers = []
            for p in b.column(1).to_pylist():
                try:
                    answers.append(retried(lambda p=p: completer(p)))
                except Exception as e:  # a port may fail in any way; the row says so
                    answers.append(f"call failed: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(answers, pa.string())], [key, "answer"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, prompt).mapInArrow(run, f"{key} {kind}, answer string")


def complete(rows: DataFrame, key: str, prompt: str, completer: Completer) -> DataFrame:
    """(key, ok, score, reason, error) of the calls."""
    return answered(rows, key, prompt, completer).select(key, verdict_of(F.col("answer")).alias("v")).select(key, "v.*")


# ---- messages ----

Send = Callable[[str], None]


def poster(send: Callable[[str], str], name: str = "engine", icon: str = "") -> Send:
    """Posts a text as the payload of a hook, whose answer may be any text; refusals are tried again."""
    return lambda text: (retried(lambda: send(json.dumps({"text": text, "username": name, "icon": icon}))), None)[1]


def silent(seen: Callable[[str], None]) -> Send:
    """Posts nothing: for dry runs and where no hook is set."""
    return seen


def post_digest(notices: DataFrame, head: str, post: Send, most: int = 200) -> int:
    """One message of a digest's notices in order, at most ``most`` of them (a message has a limit); how many there were.

    Without any the message says so, so that silence always means a failure.
    """
    rows = notices.filter("notice <> ''").orderBy("position").limit(most + 1).collect()
    shown = [r["notice"] for r in rows[:most]]
    more = ["…"] if len(rows) > most else []
    post("\n\n".join([head, *shown, *more]) if shown else f"{head}\n\nNothing needs your attention tonight.")
    return len(shown)
