"""Parameter study: seeded sampling of a space, pruned by successive halving.

Trial t takes for each parameter a number in [0, 1) from the md5 of seed, trial and name, so a
study repeats anywhere and any trial can be drawn without the others. The first rung trains
all trials with few boosting rounds; each further rung trains the best of them with more. A trial's score on a
rung is the best of its staged metric on fold 0 within the rung's rounds, so what a rung compares is what
stopping on the metric would keep.

Results go to one table per (rung, trial) in the study's folder. A study that was stopped goes on with the
first trial that has no result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.plans.models import tree_table_of
from rowtide.plans.staged import curve, staged_margins
from rowtide.plans.training import TrainSpec, fit_fold
from rowtide.sources.cache import finished, require_same


@dataclass(frozen=True)
class Between:
    """Numbers from ``low`` to ``high``; ``log`` spreads them by ratio, ``whole`` takes whole ones, both ends included."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def at(self, u: float) -> float | int:
        if self.whole:
            return int(self.low + math.floor(u * (self.high - self.low + 1)))
        if self.log:
            return self.low * (self.high / self.low) ** u
        return self.low + u * (self.high - self.low)


@dataclass(frozen=True)
class OneOf:
    values: tuple

    def at(self, u: float):
        return self.values[math.floor(u * len(self.values))]


Space = Mapping[str, Between | OneOf]


@dataclass(frozen=True)
class Halving:
    """Trials of the first rung, its boosting rounds, and by how much trials shrink and rounds grow from rung to rung."""

    trials: int = 100
    rounds: int = 50
    factor: int = 3
    most_rounds: int = 4000

    def rungs(self) -> list[tuple[int, int]]:
        """(trials, rounds) of each rung; the last has one trial or the most rounds."""
        out, n, rounds = [], self.trials, self.rounds
        while True:
            out.append((n, min(rounds, self.most_rounds)))
            if n == 1 or rounds >= self.most_rounds:
                return out
            n, rounds = math.ceil(n / self.factor), rounds * self.factor


def drawn(seed: int, trial: int, name: str) -> float:
    """A number in [0, 1): the first 48 bits of a digest."""
    return int(hashlib.md5(f"{seed}:{trial}:{name}".encode()).hexdigest()[:12], 16) / (1 << 48)


def sample(space: Space, seed: int, trial: int) -> dict[str, object]:
    return {name: choice.at(drawn(seed, trial, name)) for name, choice in space.items()}


_RESULT = "rung int, trial int, rounds int, iteration int, score double"


def _judged(train: DataFrame, spec: TrainSpec, rounds: int, fold: int) -> tuple[int, float | None]:
    """(best round, its score) on the held-out fold."""
    fit_fold(train, spec, fold)
    nodes = tree_table_of(train.sparkSession, spec, fold)
    margins = staged_margins(train.filter(F.col("fold") == fold), spec, nodes)
    best = curve(margins, spec.key).orderBy(F.desc_nulls_last("score"), "iteration").first()
    return best["iteration"], best["score"]


def study(
    train: DataFrame, spec: TrainSpec, space: Space, folder: str, halving: Halving = Halving(), seed: int = 7, fold: int = 0
) -> DataFrame:
    """rung, trial, rounds, iteration (the best), score, place (from 1), survives; the table of all rungs.

    ``spec`` gives what the space doesn't; ``train`` is a stored table with ``fold``. Trials that tie keep the
    order of their numbers; a missing score is the worst.
    """
    spark = train.sparkSession
    require_same(spark, folder, f"{replace(spec, folder='').fingerprint}:{space}:{halving}:{seed}:{fold}")
    rungs, alive, paths = halving.rungs(), list(range(halving.trials)), []
    for rung, (_, rounds) in enumerate(rungs):
        for trial in alive:
            path = f"{folder}/rung_{rung}/trial_{trial}"
            if not finished(spark, path):
                params = {**dict(spec.params), **sample(space, seed, trial), "maxIter": rounds}
                own = replace(spec, folder=f"{path}_model", params=tuple(params.items()), stop="metric")
                iteration, score = _judged(train, own, rounds, fold)
                row = spark.createDataFrame([(rung, trial, rounds, iteration, score)], _RESULT)
                row.coalesce(1).write.mode("overwrite").parquet(path)
            paths.append(path)
        placed = ranked(spark.read.schema(_RESULT).parquet(*paths), rungs)
        alive = sorted(r["trial"] for r in placed.filter((F.col("rung") == rung) & F.col("survives")).select("trial").collect())
    return ranked(spark.read.schema(_RESULT).parquet(*paths), rungs)


def ranked(results: DataFrame, rungs: list[tuple[int, int]]) -> DataFrame:
    """Place of every trial on its rung, and whether it goes on; a rung has as many rows as trials."""
    order = Window.partitionBy("rung").orderBy(F.desc_nulls_last("score"), "trial")
    goes_on = F.create_map(*[F.lit(v) for i, (n, _) in enumerate(rungs[1:] + [(1, 0)]) for v in (i, n)])
    placed = results.withColumn("place", F.row_number().over(order))
    return placed.withColumn("survives", F.col("place") <= goes_on[F.col("rung")])


def trials_table(spark: SparkSession, space: Space, trials: int, seed: int) -> DataFrame:
    """The drawn parameters, as text: trial, name, value."""
    rows = [(t, n, str(v)) for t in range(trials) for n, v in sample(space, seed, t).items()]
    return spark.createDataFrame(rows, "trial int, name string, value string")
