"""Dialogue scorers as column expressions; every text is scored whole."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default lexicon and patterns the scores are defined on.
TOXIC_WORDS = (
    "grosero", "insulto", "estafa", "robo", "estafador",
    "fake", "mierda", "basura", "hacker", "joder",
)
INJECTION_PATTERNS = (
    "ignora las instrucciones",
    "ignora la directiva",
    "ignore previous instructions",
    "system prompt",
    "modo dan",
    "actua como",
    "eres un modelo",
    "olvida todo",
)
FAILURE_PATTERNS = (
    "no puedo responder",
    "lo siento",
    "error en el sistema",
    "fallo interno",
)


def _hits(tests: Iterable[Column]) -> Column:
    total = F.lit(0)
    for test in tests:
        total = total + test.cast("int")
    return total


def _zero_if_empty(text: Column, score: Column) -> Column:
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(score)


def toxicity_score(text: Column, words: Iterable[str] | None = None) -> Column:
    """A third per lexicon word found as a substring, 1.0 at most."""
    lowered = F.lower(text)
    found = _hits(F.contains(lowered, F.lit(w)) for w in tuple(words or ()) or TOXIC_WORDS)
    return _zero_if_empty(text, F.least(found / F.lit(3.0), F.lit(1.0)))


def prompt_injection_score(
    text: Column, patterns: Iterable[str] = INJECTION_PATTERNS
) -> Column:
    """A half per pattern found, 1.0 at most."""
    lowered = F.lower(text)
    found = _hits(lowered.rlike(p) for p in patterns)
    return _zero_if_empty(text, F.least(found / F.lit(2.0), F.lit(1.0)))


def fidelity_score(text: Column, patterns: Iterable[str] = FAILURE_PATTERNS) -> Column:
    """1.0 less a half per failure pattern found, 0.0 at least; an empty answer scores 0.0."""
    lowered = F.lower(text)
    found = _hits(lowered.rlike(p) for p in patterns)
    return _zero_if_empty(
        text, F.greatest(F.lit(1.0) - found * F.lit(0.5), F.lit(0.0))
    )
