"""Synthetic credit scores as column expressions.

The five score types are one constant array, so no join is needed: each function
picks an element by a hash of the row's key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import Hasher, draw, stable_hash


@dataclass(frozen=True)
class ScoreType:
    name: str
    providers: tuple[str, ...]
    low: int
    high: int


# Score types with their providers and inclusive ranges.
FICO8 = ScoreType("FICO Score 8", ("Equifax", "Experian", "TransUnion"), 300, 850)
FICO5 = ScoreType("Equifax Beacon 5.0", ("Equifax",), 334, 818)
FICO2 = ScoreType("Experian/Fair Isaac Risk Model V2SM", ("Experian",), 320, 844)
FICO4 = ScoreType("TransUnion FICO Risk Score, Classic 04", ("TransUnion",), 309, 839)

# "fico" is another name of fico8, so a random pick takes that type twice as often.
SCORE_TYPES: dict[str, ScoreType] = {
    "fico8": FICO8,
    "fico5": FICO5,
    "fico2": FICO2,
    "fico4": FICO4,
    "fico": FICO8,
}


def _literal(kind: ScoreType) -> Column:
    return F.struct(
        F.lit(kind.name).alias("name"),
        F.array(*[F.lit(p) for p in kind.providers]).alias("providers"),
        F.lit(kind.low).cast("bigint").alias("low"),
        F.lit(kind.high).cast("bigint").alias("high"),
    )


def _pick(key: Column, score_type: ScoreType | str | None, purpose: str, hasher: Hasher) -> Column:
    """The type itself if one is given, else one of the five by the row's key."""
    if score_type is None:
        choices = F.array(*[_literal(kind) for kind in SCORE_TYPES.values()])
        return F.get(choices, draw(key, purpose, len(SCORE_TYPES), hasher).cast("int"))
    if isinstance(score_type, ScoreType):
        return _literal(score_type)
    if score_type not in SCORE_TYPES:
        raise ValueError(f"unknown score type {score_type!r}; known: {list(SCORE_TYPES)}")
    return _literal(SCORE_TYPES[score_type])


def _provider(key: Column, kind: Column, hasher: Hasher) -> Column:
    providers = kind["providers"]
    drawn = hasher(key, F.lit("provider")) % F.size(providers)
    return F.get(providers, drawn.cast("int"))


def _score(key: Column, kind: Column, hasher: Hasher) -> Column:
    return kind["low"] + hasher(key, F.lit("score")) % (kind["high"] - kind["low"] + 1)


def credit_score_name(
    key: Column, score_type: ScoreType | str | None = None, hasher: Hasher = stable_hash
) -> Column:
    return _pick(key, score_type, "name type", hasher)["name"]


def credit_score_provider(
    key: Column, score_type: ScoreType | str | None = None, hasher: Hasher = stable_hash
) -> Column:
    return _provider(key, _pick(key, score_type, "provider type", hasher), hasher)


def credit_score(
    key: Column, score_type: ScoreType | str | None = None, hasher: Hasher = stable_hash
) -> Column:
    return _score(key, _pick(key, score_type, "score type", hasher), hasher)


def credit_score_full(
    key: Column, score_type: ScoreType | str | None = None, hasher: Hasher = stable_hash
) -> Column:
    """Name, provider and score of one type, a line each."""
    kind = _pick(key, score_type, "full type", hasher)
    score = _score(key, kind, hasher).cast("string")
    return F.concat_ws("\n", kind["name"], _provider(key, kind, hasher), score, F.lit(""))
