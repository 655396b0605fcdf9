"""Mixing sources to target weights by iterative proportional fitting.

Token counts per cell (source, language, topic) are raked until their sums follow the target shares of all three.
Documents are then sampled with probabilities proportional to their cell's weight, with one factor that makes the
expected number of tokens the wanted share of all. Where that factor takes cells whole, the sample misses the targets:
`mix_margins` shows by how much, and `follow_targets` takes as many tokens as the targets allow and no more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "(other)"
ROUNDS = 25
#: Cells are combinations of named categories and OTHER, so their number is a property of the targets.
MOST_CELLS = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def rake(tokens: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Weights w per cell: the sums of w * tokens over each margin's categories follow its targets.

    members[m][c] is cell c's category of margin m. Categories without tokens drop out, the others share their target.
    """
    weight = np.ones(len(tokens))
    goals = []
    for member, target in zip(members, targets, strict=True):
        present = np.bincount(member, tokens, len(target)) > 0
        goal = np.where(present, target, 0.0)
        goals.append(goal / goal.sum() * tokens.sum() if goal.sum() else present * tokens.sum() / max(present.sum(), 1))
    for _ in range(rounds):
        for member, goal in zip(members, goals, strict=True):
            now = np.bincount(member, weight * tokens, len(goal))
            weight = weight * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[member]
    return weight


def probabilities(tokens: np.ndarray, weight: np.ndarray, budget: float) -> np.ndarray:
    """min(1, factor * weight) with the factor that spends `budget` tokens in expectation, or as many as weights allow."""
    order = np.argsort(-weight, kind="stable")
    w, t = weight[order], tokens[order]
    full = np.concatenate([[0.0], np.cumsum(t)])  # tokens of the k heaviest cells, taken whole
    rest = (w * t)[::-1].cumsum()[::-1]
    for k in range(len(w)):
        factor = (budget - full[k]) / rest[k] if rest[k] > 0 else 0.0
        if factor * w[k] <= 1:
            return np.clip(factor * weight, 0.0, 1.0) if k == 0 else np.where(np.argsort(order) < k, 1.0, np.clip(factor * weight, 0.0, 1.0))
    return np.ones(len(w))


def group(column: Column, targets: dict[str, float]) -> Column:
    return F.when(column.isin([t for t in targets if t != OTHER]), column).otherwise(F.lit(OTHER))


def mix_sources(
    docs: DataFrame, topic: Column, targets: dict[str, dict[str, float]], budget: float, rounds: int = ROUNDS, follow_targets: bool = False
) -> DataFrame:
    """All columns of `docs`, and mix_source, mix_lang, mix_topic, mix_tokens, probability and kept.

    `targets` has the keys source, lang and topic, each with target shares of tokens by category; every other value,
    NULL included, is the category "(other)". `budget` is the share of all tokens to keep in expectation; with `follow_targets`
    it is lowered until no cell is taken beyond its weight, so that the sample's shares are the targets. Whether a document is
    kept follows from a hash of its id (or of its text, if it has no id), so repeated rows stay or go together. A text
    without words counts one token. An empty table gives no rows.
    """
    shape = [sorted({*targets[m], OTHER}) for m in ("source", "lang", "topic")]
    if np.prod([len(s) for s in shape]) > MOST_CELLS:
        raise ValueError("too many target categories")
    names = [c for c in docs.columns if c not in ("mix_source", "mix_lang", "mix_topic", "mix_tokens", "probability", "kept")]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in names], group(F.col("source"), targets["source"]).alias("mix_source"),
        group(F.col("lang"), targets["lang"]).alias("mix_lang"), group(topic, targets["topic"]).alias("mix_topic"),
        F.greatest(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)), F.lit(1)).cast("long").alias("mix_tokens"),
    )
    margins = ["mix_source", "mix_lang", "mix_topic"]
    cells = rows.groupBy(*margins).agg(F.sum("mix_tokens").alias("n")).orderBy(*margins).collect()  # MOST_CELLS at most
    tokens = np.array([c["n"] for c in cells], float)
    members = [np.array([s.index(c[m]) for c in cells], int) for m, s in zip(margins, shape, strict=True)]
    goals = [np.array([targets[m].get(x, 0.0) for x in s]) for m, s in zip(("source", "lang", "topic"), shape, strict=True)]
    weight = rake(tokens, members, goals, rounds)
    if follow_targets and len(weight):
        budget = min(budget, (weight * tokens).sum() / tokens.sum() / weight.max())
    chance = probabilities(tokens, weight, budget * tokens.sum())
    table = docs.sparkSession.createDataFrame(
        [(*[c[m] for m in margins], float(p)) for c, p in zip(cells, chance, strict=True)],
        "mix_source string, mix_lang string, mix_topic string, probability double",
    )
    seed = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    draw = F.conv(F.substring(F.md5(seed), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))
    return (
        rows.join(F.broadcast(table), margins).select(*names, *margins, "mix_tokens", "probability")
        .withColumn("kept", draw < F.col("probability"))
    )


def mix_margins(mixed: DataFrame, targets: dict[str, dict[str, float]]) -> list[tuple[str, str, float, float, float]]:
    """(margin, category, target, expected share of the sample, share of all tokens) of a result of `mix_sources`.

    Targets are shares among the categories that have tokens.
    """
    columns = {m: f"mix_{m}" for m in ("source", "lang", "topic")}
    cells = mixed.groupBy(*columns.values()).agg(F.sum("mix_tokens").alias("n"), F.sum(F.col("mix_tokens") * F.col("probability")).alias("kept"))
    rows = cells.collect()  # MOST_CELLS at most
    out = []
    for margin, column in columns.items():
        present = sorted({r[column] for r in rows})
        goal = {c: targets[margin].get(c, 0.0) for c in present}
        for c in present:
            of = [r for r in rows if r[column] == c]
            out.append((
                margin, c, goal[c] / sum(goal.values()) if sum(goal.values()) else 1 / len(present),
                sum(r["kept"] for r in of) / (sum(r["kept"] for r in rows) or 1.0), sum(r["n"] for r in of) / sum(r["n"] for r in rows),
            ))
    return out
