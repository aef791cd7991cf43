"""Sentiment of text: a lexicon score inside the JVM, and a batch scorer for models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K

LABELS = ("positive", "negative", "neutral")


def _valences(words: pa.Array, keys: pa.Array, values: np.ndarray) -> np.ndarray:
    """The valence of each word, 0 if unknown; a hash look-up whatever the lexicon's size."""
    at = pc.index_in(words, value_set=keys)
    known = np.asarray(at.is_valid())
    out = np.zeros(len(words))
    out[known] = values[np.asarray(at.drop_null())]
    return out


def _table(lexicon: dict[str, float]) -> tuple[pa.Array, np.ndarray]:
    return pa.array(list(lexicon), pa.string()), np.array(list(lexicon.values()), float)


def lexicon_score(df: DataFrame, key: list[str], text: str, lexicon: dict[str, float] = K.LEXICON,
                  alpha: float = K.LEXICON_ALPHA) -> DataFrame:
    """Compound score s / sqrt(s² + alpha), s the summed valence of the words. The lexicon
    travels with the task and is looked up by hash for all words of an Arrow batch, so
    neither its size nor a join counts. A NULL or empty text scores 0."""
    names = [f"k{i}" for i in range(len(key))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(key, names)], F.lower(text).alias("t"))

    def run(batches):
        keys, values = _table(lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words = pc.split_pattern_regex(part.column("t").cast(pa.string()).fill_null(""), pattern=r"[^\p{L}]+")
                owner = np.repeat(np.arange(part.num_rows), np.asarray(pc.list_value_length(words)))
                s = np.bincount(owner, _valences(words.flatten(), keys, values), part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(s / np.sqrt(s * s + alpha))], names=[*names, "compound"])

    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    scored = rows.mapInArrow(run, f"{kinds}, compound double")
    return scored.toDF(*key, "compound")


def lexicon_scorer(lexicon: dict[str, float] = K.LEXICON) -> Callable[[pd.Series], np.ndarray]:
    """Default model: class logits from positive and negative word weight."""
    keys, values = _table(lexicon)

    def logits(texts: pd.Series) -> np.ndarray:
        words = pc.utf8_split_whitespace(pa.array(texts, pa.string()).fill_null(""))
        owner = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(words)))
        v = _valences(pc.utf8_lower(pc.utf8_trim(words.flatten(), characters=".,:;!?|\"'")), keys, values)
        pos, neg = (np.bincount(owner, np.maximum(x, 0), len(texts)) for x in (v, -v))
        return np.column_stack([pos, neg, np.full(len(texts), 0.5)])
    return logits


def score_texts(df: DataFrame, text: str, load: Callable[[], Callable] = lexicon_scorer, batch: int = 64) -> DataFrame:
    """Add tone_label, tone_score and three probabilities. ``load`` runs once per task
    and returns a function from texts to (n, 3) logits; texts keep their row."""
    schema = "tone_label string, tone_score double, prob_pos double, prob_neg double, prob_neu double"

    @F.pandas_udf(schema)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in parts:
            chunks = [model(texts.iloc[i:i + batch]) for i in range(0, len(texts), batch)]
            z = np.concatenate(chunks) if chunks else np.zeros((0, 3))
            e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
            p = e / e.sum(axis=1, keepdims=True) if len(z) else e
            top = p.argmax(axis=1) if len(p) else np.zeros(0, dtype=int)
            q = np.round(p, 4)
            yield pd.DataFrame({"tone_label": [LABELS[i] for i in top], "tone_score": q[np.arange(len(q)), top],
                                "prob_pos": q[:, 0], "prob_neg": q[:, 1], "prob_neu": q[:, 2]})

    return df.withColumn("_t", run(F.coalesce(text, F.lit("")))).select(*df.columns, "_t.*")


LABELS_OUT = ["tone_label", "tone_score", "prob_pos", "prob_neg", "prob_neu"]
