"""Model-backed functions over an injected client.

A client is any callable that takes (settings, prompt) and returns the answer; without one
these functions raise when a query is built. Results are null where a client fails, so an
error text never passes for an answer, and the failures are counted in an accumulator,
``failures(spark)``. Calls are batched as Arrow columns.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Client = Callable[[dict, str], str]
_failed: dict[str, object] = {}


def failures(spark: SparkSession):
    """The accumulator of failed calls of this application."""
    key = spark.sparkContext.applicationId
    if key not in _failed:
        _failed[key] = spark.sparkContext.accumulator(0)
    return _failed[key]


def ask(client: Client | None, settings: dict, task: Column | str, content: Column) -> Column:
    """The answer for each row; null content gives an empty answer without a call."""
    if client is None:
        raise ValueError("model functions need a client: the option llm_client")
    failed = failures(SparkSession.active())

    @F.pandas_udf("string")
    def run(tasks: pd.Series, texts: pd.Series) -> pd.Series:
        def one(task, text):
            if text is None or not str(text).strip():
                return ""
            try:
                return client(settings, f"{task}\n{text}")
            except Exception:  # noqa: BLE001
                failed.add(1)
                return None

        return pd.Series([one(t, x) for t, x in zip(tasks, texts)], dtype=object)

    return run(F.lit(task) if isinstance(task, str) else task, content.cast("string"))


def build(client: Client | None, settings: dict) -> dict[str, Callable[..., Column]]:
    """The functions of one model row, by lower-cased name."""
    a = lambda task, text: ask(client, settings, task, text)
    mood = lambda text: F.lower(a("sentiment", text))
    entities = lambda text: F.from_json(F.lower(a("entities", text)), "entities array<string>")["entities"]

    def sentiment(text, strict=None):
        low = mood(text)
        out = F.when(low.contains("positive"), "POSITIVE").when(low.contains("negative"), "NEGATIVE").when(low.contains("neutral"), "NEUTRAL")
        return out.otherwise("UNKNOWN")

    return {
        "iscontentabout": lambda text, question: F.coalesce(F.lower(a(F.concat(F.lit("about "), question), text)).contains("yes"), F.lit(False)),
        "sentiment": sentiment,
        "summarizecontent": lambda text: a("summarize", text),
        "translatecontent": lambda text, source, target: a(F.concat(F.lit("translate "), source, F.lit(" to "), target), text),
        "entities": lambda text, strict=None: F.coalesce(entities(text), F.array().cast("array<string>")),
        "describeimage": lambda image: a("describe image", image),
        "askimage": lambda question, image: a(F.concat(F.lit("image "), question), image),
        "isquestionapplicabletoimage": lambda question, image: F.coalesce(F.get_json_object(a(F.concat(F.lit("applies "), question), image), "$.result") == "true", F.lit(False)),
        "llmperform": lambda task, value: a(task, value),
        "counttokens": lambda *args: count_tokens(args[-1], args[0] if len(args) > 1 else None),
    }


#: Tokens of an encoder, built once in a process.
_encoders: dict[str, object] = {}


def _encoder(name: str):
    """The encoding of a name: one of tiktoken's, or a rank file of the ``public_tokenizers`` package."""
    if name not in _encoders:
        import base64
        import os

        import public_tokenizers
        import tiktoken

        path = name if os.path.isfile(name) else public_tokenizers.path(name if name.endswith(".tiktoken") else f"{name}.tiktoken")
        if os.path.isfile(path):
            with open(path, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _encoders[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        else:
            _encoders[name] = tiktoken.get_encoding(name)
    return _encoders[name]


#: The encoding where none is named.
ENCODING = "byte_bpe_50k"


def count_tokens(text: Column, encoding: Column | None = None) -> Column:
    """Byte-pair tokens of a text in a named encoding; null counts none. An unknown encoding raises."""

    @F.pandas_udf("int")
    def run(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([len(_encoder(n).encode_ordinary(t)) if t else 0 for t, n in zip(texts, names)], dtype="int32")

    return run(text, F.lit(ENCODING) if encoding is None else encoding)
