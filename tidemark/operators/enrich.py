"""Batch text generation and embedding through a pluggable provider."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import json_scalar
from tidemark.operators.grouping import nested_parts, text_digest
from tidemark.session import materialize

# Fixed value: where the answer text sits in a generation result.
ANSWER_PATH = "$.candidates[0].content.parts[0].text"
GENERATED = "status string, result string"
# Rows of one provider request.
ROWS_PER_REQUEST = 64
EMBEDDED = "status string, embedding array<double>, token_count int, truncated boolean"


@dataclass(frozen=True)
class GenerateOptions:
    temperature: float = 0.0
    max_output_tokens: int = 60


class TextProvider(Protocol):
    """Answers prompts; ``files`` holds the file references that go with each prompt."""

    def generate(
        self, prompts: list[str], files: list[list[str]], options: GenerateOptions
    ) -> list[tuple[str, str | None]]: ...


class EmbeddingProvider(Protocol):
    """Vector, token count and truncation flag per text, with a status."""

    def embed(self, texts: list[str], task: str) -> list[tuple[str, list[float], int, bool]]: ...


class OfflineText:
    """Deterministic stand-in without a network: reports the size of the prompt."""

    def generate(self, prompts, files, options):
        out = []
        for prompt, uris in zip(prompts, files):
            text = f"{len(prompt)} characters in {prompt.count(chr(10)) + 1} lines"
            if uris:
                text += f", {len(uris)} files"
            out.append(("", json.dumps({"candidates": [{"content": {"parts": [{"text": text}]}}]})))
        return out


class OfflineEmbedding:
    """Deterministic stand-in: letter frequencies of the whole text, scaled to length one."""

    LETTERS = "abcdefghijklmnopqrstuvwxyz"

    def embed(self, texts, task):
        out = []
        for text in texts:
            low = text.lower()
            counts = np.array([low.count(c) for c in self.LETTERS], dtype=float)
            size = float(np.sqrt((counts * counts).sum()))
            vector = (counts / size).tolist() if size else []
            out.append(("", vector, len(text.split(" ")), False))
        return out


def _in_requests(call: Callable, rows: list[int], size: int | None = None) -> Iterator[tuple]:
    """(row, answer) from requests of ``size`` rows; the rows of a request that fails are sent one by one, and an
    error is then that row's own answer."""
    size = size or ROWS_PER_REQUEST
    for at in range(0, len(rows), size):
        some = rows[at : at + size]
        try:
            yield from zip(some, call(some), strict=True)
            continue
        except Exception:  # noqa: BLE001
            pass
        for i in some:
            try:
                yield i, call([i])[0]
            except Exception as error:  # noqa: BLE001
                yield i, error


def generate(
    df: DataFrame,
    prompt: Column,
    provider: Callable[[], TextProvider],
    prefix: str,
    options: GenerateOptions = GenerateOptions(),
    files: Column | None = None,
) -> DataFrame:
    """Adds ``<prefix>_status``, ``<prefix>_json`` and the answer ``<prefix>_result`` per row.

    ``provider`` is called once per task. A NULL prompt is not sent. An error becomes the
    status of its rows and does not fail the job. Write the result to a table before using it
    twice (``materialize``), so no call is made again.
    """

    @F.pandas_udf(GENERATED)
    def ask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        service = provider()
        for prompts, uris in batches:
            sent = [i for i, p in enumerate(prompts) if p is not None]
            rows: list = [("no prompt", None)] * len(prompts)

            def call(some, prompts=prompts, uris=uris):
                given = [[] if uris.iloc[i] is None else list(uris.iloc[i]) for i in some]
                return service.generate([prompts.iloc[i] for i in some], given, options)

            for i, answer in _in_requests(call, sent):
                rows[i] = (f"error: {answer}", None) if isinstance(answer, Exception) else answer
            yield pd.DataFrame(rows, columns=["status", "result"])

    file_list = F.lit(None).cast("array<string>") if files is None else files
    out = df.withColumn("_reply", ask.asNondeterministic()(prompt, file_list))
    return out.withColumns(
        {
            f"{prefix}_status": F.col("_reply.status"),
            f"{prefix}_json": F.col("_reply.result"),
            f"{prefix}_result": json_scalar("_reply.result", ANSWER_PATH),
        }
    ).drop("_reply")


def generate_per_group(
    df: DataFrame,
    keys: Sequence[str],
    uri: str,
    order_by: str,
    prompt: Column,
    provider: Callable[[], TextProvider],
    prefix: str,
    files_per_request: int = 300,
    options: GenerateOptions = GenerateOptions(),
) -> DataFrame:
    """One answer per group over all its files: a larger group's parts are asked first, then all their answers."""
    lists = materialize(nested_parts(df, keys, order_by, files_per_request, [uri], "_files"), "file-lists")
    uris = F.transform("_files", lambda r: r[uri])
    answers = materialize(generate(lists, prompt, provider, prefix, options, uris).drop("_files"), "part-answers")
    while answers.where("part > 0").take(1):
        # the answers of a group's parts become one text, and the prompt over it gives the group's answer
        split = materialize(answers.where("part > 0").select(*keys).distinct(), "split-groups")
        texts = answers.join(split, list(keys), "left_semi").withColumnRenamed("part", "_part")
        merged = text_digest(texts, keys, F.coalesce(f"{prefix}_result", F.lit("")), "_part", max(2, files_per_request), "_answers", "\n\n")
        final = generate(merged, F.concat(prompt, F.lit("\n\n"), "_answers"), provider, prefix, options)
        whole = answers.join(split, list(keys), "left_anti")
        answers = materialize(whole.unionByName(final.select(*whole.columns)), "group-answers")
    return answers.drop("part")


def embed(
    df: DataFrame,
    text: Column,
    provider: Callable[[], EmbeddingProvider],
    prefix: str,
    task: str = "SEMANTIC_SIMILARITY",
) -> DataFrame:
    """Adds status, vector, vector length, token count and truncation flag of a text column.

    A NULL text gives an empty vector and is not sent.
    """

    @F.pandas_udf(EMBEDDED)
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        service = provider()
        for texts in batches:
            sent = [i for i, t in enumerate(texts) if t is not None]
            rows: list = [("no text", [], None, None)] * len(texts)
            for i, answer in _in_requests(lambda some, texts=texts: service.embed([texts.iloc[i] for i in some], task), sent):
                rows[i] = (f"error: {answer}", [], None, None) if isinstance(answer, Exception) else answer
            names = ["status", "embedding", "token_count", "truncated"]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"token_count": "Int32", "truncated": "boolean"})

    out = df.withColumn("_reply", ask.asNondeterministic()(text))
    return out.withColumns(
        {
            f"{prefix}_embedding_status": F.col("_reply.status"),
            f"{prefix}_embedding_token_count": F.col("_reply.token_count"),
            f"{prefix}_embedding_truncated": F.col("_reply.truncated"),
            f"{prefix}_embedding": F.col("_reply.embedding"),
            f"{prefix}_embedding_length": F.size("_reply.embedding"),
        }
    ).drop("_reply")
