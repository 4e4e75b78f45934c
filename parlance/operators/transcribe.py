"""UDF1: the pluggable scorer contract.

A scorer module exposes ``create_app(**kwargs) -> fn`` where ``fn(entry: dict) ->
(text, seconds)``. The factory runs once per partition inside ``mapInPandas`` (state
such as a loaded model is built per task, never shipped from the driver), and
``fn`` runs per row. ``repartition(n)`` before the call bounds concurrency the way
the reference's worker count does.
"""

from __future__ import annotations

import importlib
import importlib.util
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def load_factory(path_or_module: str) -> Callable[..., Callable[[dict], tuple[str, float]]]:
    """Resolve ``create_app`` from a file path or an importable module name."""
    if path_or_module.endswith(".py"):
        spec = importlib.util.spec_from_file_location("parlance_scorer", path_or_module)
        mod = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(mod)
    else:
        mod = importlib.import_module(path_or_module)
    return mod.create_app


def transcribe(df: DataFrame, factory: Callable[..., Callable[[dict], tuple[str, float]]],
               factory_kwargs: dict | None = None, input_cols: list[str] | None = None,
               num_tasks: int | None = None) -> DataFrame:
    """Add ``predicted_text`` and ``transcription_time`` by calling the scorer per row."""
    kwargs = dict(factory_kwargs or {})
    cols = input_cols or df.columns
    schema = T.StructType(list(df.schema.fields) + [
        T.StructField("predicted_text", T.StringType()),
        T.StructField("transcription_time", T.DoubleType())])

    def run(batches):
        fn = factory(**kwargs)  # once per task
        for pdf in batches:
            texts, secs = [], []
            for rec in pdf[cols].to_dict(orient="records"):
                t0 = time.perf_counter()
                out = fn(rec)
                if isinstance(out, tuple):
                    text, sec = out
                else:
                    text, sec = out, time.perf_counter() - t0
                texts.append(text)
                secs.append(float(sec))
            yield pdf.assign(predicted_text=pd.Series(texts, index=pdf.index, dtype=object),
                             transcription_time=pd.Series(secs, index=pdf.index, dtype="float64"))

    src = df.repartition(num_tasks) if num_tasks else df
    return src.mapInPandas(run, schema)


def example_scorer_factory(drop_every: int = 5, drop_at: int = 2, reverse_every: int = 3):
    """A deterministic pure-Python scorer for tests and the catalog: drops the words of
    index i % drop_every == drop_at, reverses those of i % reverse_every == 0, and reports
    1 ms per input character as its time."""
    def fn(entry: dict) -> tuple[str, float]:
        text = entry.get("text") or ""
        words = text.split()
        out = [w[::-1] if i % reverse_every == 0 else w for i, w in enumerate(words) if i % drop_every != drop_at]
        return " ".join(out), 0.001 * len(text)
    return fn
