"""Model calls per window, with stored responses, so that a window is never sent twice; and the resume sets."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.prompts import JUDGE, filled

_OUT = "win_idx long, ok boolean, response string, error string, prompt_tokens long, completion_tokens long"


def called(client: Callable[[str], dict], prompt: str, attempts: int, first_wait: float, most_wait: float) -> tuple[dict, str]:
    """The client's answer and '' or, if no attempt gave a JSON object, the last answer and the error. Waits double between attempts."""
    got, error = {}, ""
    for n in range(attempts):
        if n:
            time.sleep(min(most_wait, first_wait * 2 ** (n - 1)))
        try:
            got = client(prompt)
            text = got["response"]
            got = got | {"object": json.loads(text[text.find("{") : text.rfind("}") + 1])}
            return got, ""
        except Exception as e:  # any failure of the client is the call's failure
            error = str(e)[:500] or type(e).__name__
    return got, error


def generate(prompts: DataFrame, make_client: Callable[[], Callable[[str], dict]], attempts: int = 3, first_wait: float = 1.0, most_wait: float = 8.0) -> DataFrame:
    """Responses to ``prompts`` (win_idx, prompt). ``make_client`` makes one client per task, which maps a prompt to {"response", "prompt_tokens", "completion_tokens"}.
    A call is tried ``attempts`` times, with doubling waits; a response that is no JSON object counts as failed. A window that fails has ok false and emits no records later."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            out = []
            for win, prompt in zip(batch["win_idx"], batch["prompt"], strict=True):
                got, error = called(client, prompt, attempts, first_wait, most_wait)
                out.append((win, not error, got.get("response"), error, got.get("prompt_tokens", 0), got.get("completion_tokens", 0)))
            yield pd.DataFrame(out, columns=["win_idx", "ok", "response", "error", "prompt_tokens", "completion_tokens"])

    return prompts.select("win_idx", "prompt").mapInPandas(run, _OUT)


def judge(records: DataFrame, make_client: Callable[[], Callable[[str], dict]], template: str = JUDGE, least: int = 4, attempts: int = 3, first_wait: float = 1.0, most_wait: float = 8.0) -> DataFrame:
    """The rows of ``records`` (data_type, question, answers, docs, …) that a judge lets pass: paraphrases, and those all of whose answers get ``least`` or more for the first document.
    The questions of a record are asked in order until one falls below; a call that fails, or a score that is missing or no number, counts as 0."""
    pairs = F.arrays_zip(F.col("question").alias("q"), F.col("answers").alias("a"))
    pairs = F.slice(pairs, 1, F.least(F.size("question"), F.size("answers")))
    prompts = F.transform(pairs, lambda x: filled(template, doc=F.get("docs", F.lit(0)), question=x["q"], answer=x["a"]))
    prompts = F.when(F.col("data_type").eqNullSafe("paraphrase"), F.array().cast("array<string>")).otherwise(F.coalesce(prompts, F.array().cast("array<string>")))

    def passes(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = make_client()

        def score(prompt: str) -> int:
            got, error = called(client, prompt, attempts, first_wait, most_wait)
            try:
                return 0 if error else int(got["object"].get("score", 0))
            except (TypeError, ValueError, OverflowError):
                return 0

        for batch in lists:
            yield batch.map(lambda xs: all(score(x) >= least for x in xs)).astype(bool)

    asked = F.pandas_udf(passes, "boolean").asNondeterministic()
    return records.filter(asked(prompts))


def to_do(windows: DataFrame, done: DataFrame, start: int | None = None, limit: int | None = None) -> DataFrame:
    """Windows (win_idx) to process: all that are not done (win_idx, status 'processed'; failed ones are tried again), or all from ``start`` on."""
    if start is not None:
        rows = windows.filter(F.col("win_idx") >= start)
    else:
        state = done.groupBy("win_idx").agg(F.max(F.col("status") == "failed").alias("failed"))
        rows = windows.join(state.filter(~F.col("failed")).select("win_idx"), "win_idx", "left_anti")
    return rows if limit is None else rows.orderBy("win_idx").limit(limit)


def progress(done: DataFrame) -> DataFrame:
    return done.agg(F.count_distinct(F.when(F.col("status") == "processed", F.col("win_idx"))).alias("processed_count"), F.count_distinct(F.when(F.col("status") == "failed", F.col("win_idx"))).alias("failed_count"))
