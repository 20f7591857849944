"""Ledger of external calls: each request is paid once, whatever is computed of its reply.

A request is told by the digest of its step, model and prompt.  Requests whose accepted
reply is stored call nobody.  The others are asked in batches; a batch writes its replies
as one file of the ledger before the task goes on, so that neither another action, nor a
task that is repeated, nor a run that fails later asks again.  A reply that is refused is
stored as refused, and asked for again in the next round.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import cut, drop, opened

BATCH = 10
ROUNDS = 3
#: Of so many requests or fewer, prompts are picked where they are read.
SMALL = 500_000
_ROW = "digest string, step string, model string, attempt int, reply string, error string"

#: Prompts of one batch to as many replies.
Call = Callable[[list[str]], list[str]]
#: Normal form of a reply to a prompt; raises for one that breaks its contract.
Check = Callable[[str, str], str]


def _as_it_is(reply: str, prompt: str) -> str:
    return reply


def _answers(asked: list[str], call: Call, check: Check) -> list[tuple[str | None, str | None]]:
    """(reply, error) of each prompt; a call that fails, or answers another number, refuses its whole batch."""
    try:
        got = call(asked)
        if len(got) != len(asked):
            raise ValueError("answered for another number of prompts")
    except Exception as e:  # noqa: BLE001  an external call may fail in any way
        return [(None, str(e) or type(e).__name__)] * len(asked)
    out: list[tuple[str | None, str | None]] = []
    for prompt, reply in zip(asked, got, strict=True):
        try:
            out.append((check(reply, prompt), None))
        except Exception as e:  # noqa: BLE001  so may the check of what came
            out.append((None, str(e) or type(e).__name__))
    return out


def _ask(uri: str, step: str, model: str, call: Call, check: Check, batch: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = opened(uri)
        for part in parts:
            for k in range(0, len(part), batch):
                own = part.iloc[k : k + batch]
                digests, attempts = own["digest"].tolist(), own["attempt"].tolist()
                # The same requests at the same attempt have one file, which a repeated task finds.
                name = hashlib.sha256("\n".join(f"{d} {a}" for d, a in zip(digests, attempts, strict=True)).encode()).hexdigest()
                path = f"{folder}/{name}.json"
                if files.get_file_info(path).type == fs.FileType.NotFound:
                    found = _answers(own["prompt"].tolist(), call, check)
                    lines = [json.dumps({"digest": d, "step": step, "model": model, "attempt": a, "reply": r, "error": e}, ensure_ascii=False) for d, a, (r, e) in zip(digests, attempts, found, strict=True)]
                    with files.open_output_stream(f"{folder}/_{name}") as out:
                        out.write(("\n".join(lines) + "\n").encode())
                    files.move(f"{folder}/_{name}", path)
                yield pd.DataFrame({"n": [len(own)]})

    return run


class Ledger:
    """Replies under ``path``, a folder that driver and executors share and pyarrow can open."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        files, folder = opened(path)
        files.create_dir(folder, recursive=True)

    def rows(self, step: str | None = None, model: str | None = None) -> DataFrame:
        """(digest, step, model, attempt, reply, error): every attempt; reply is null where it was refused."""
        table = self.spark.read.schema(_ROW).json(self.path)
        if step is not None:
            table = table.where(F.col("step") == step)
        return table if model is None else table.where(F.col("model") == model)

    def accepted(self, step: str, model: str) -> DataFrame:
        """(digest, reply) of each request's first accepted reply."""
        good = self.rows(step, model).where("reply is not null")
        return good.groupBy("digest").agg(F.min_by("reply", "attempt").alias("reply"))

    def ask(self, requests: DataFrame, step: str, model: str, call: Call, check: Check = _as_it_is, batch: int = BATCH, rounds: int = ROUNDS) -> DataFrame:
        """``requests`` (prompt and others) with ``reply``, null where none was accepted in ``rounds`` more attempts.

        Calls happen here, not when the result is used.  Equal prompts are one request; a null
        prompt is none.  The result reads the ledger, so actions on it call nobody.
        """
        digest = F.sha2(F.concat_ws("\x1f", F.lit(step), F.lit(model), "prompt"), 256)
        known = requests.withColumn("digest", F.when(F.col("prompt").isNotNull(), digest))
        asked_for = known.where("digest is not null").select("digest", "prompt")
        # Rounds deal with digests; prompts are dealt once a round, one of each digest, and only those that are left.
        todo = cut(asked_for.select("digest").distinct())
        for _ in range(rounds):
            done = self.rows(step, model).groupBy("digest").agg(F.max("attempt").alias("attempt"), F.count("reply").alias("good"))
            left = todo.join(done, "digest", "left").where(F.coalesce("good", F.lit(0)) == 0)
            left = cut(left.select("digest", (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt")))
            n = left.count()
            if not n:
                drop(left)
                break
            texts = asked_for
            if n <= SMALL:
                texts = texts.withColumn("h", F.xxhash64("digest")).join(F.broadcast(left.select(F.xxhash64("digest").alias("h")).distinct()), "h", "left_semi")
            dealt = texts.groupBy("digest").agg(F.first("prompt").alias("prompt")).join(left, "digest").select("digest", "prompt", "attempt")
            # Dealt by digest already, and in order of digests within a partition, so that a repeated task makes the same batches.
            dealt = dealt.sortWithinPartitions("digest")
            dealt.mapInPandas(_ask(self.path, step, model, call, check, batch), "n int").agg(F.sum("n")).head()
            drop(left)
        drop(todo)
        return known.join(self.accepted(step, model), "digest", "left")
