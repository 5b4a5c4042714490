"""Which images a training run reads: the current version plus a replay of earlier ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.functions import paths, versions
from perennial.operators.ranking import DEFAULT_SEED, mark_share

# Fixed value: share of every earlier version that is replayed.
REPLAY_SHARE = 0.2


def images_of(objects: DataFrame, outcomes: Iterable[str] = (paths.INCORRECT,)) -> DataFrame:
    """Image objects of the given outcomes. ``objects`` has a ``path`` column."""
    path = F.col("path")
    return objects.filter(paths.is_image(path)).select(
        "path", paths.version_of(path).alias("version"), paths.outcome_of(path).alias("outcome")
    ).filter(F.col("outcome").isin(*outcomes))


def current_images(
    objects: DataFrame, version: str, outcomes: Iterable[str] = (paths.INCORRECT,)
) -> DataFrame:
    outcomes = list(outcomes)
    prefixed = F.lit(False)
    for outcome in outcomes:
        prefixed = prefixed | F.startswith(F.col("path"), F.lit(f"{version}/{outcome}/"))
    return images_of(objects.filter(prefixed), outcomes)


def list_by_prefix(objects: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    """Every image below every prefix; an image below two prefixes is listed twice."""
    path = F.col("path")
    prefixes = list(prefixes)
    wanted = F.lit(False)
    for prefix in prefixes:
        wanted = wanted | F.startswith(path, F.lit(prefix))
    hits = F.filter(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(path, p))
    return (
        objects.filter(wanted & paths.is_image(path))
        .select("path", F.explode(hits).alias("prefix"))
    )


def earlier_images(
    objects: DataFrame, version: str, outcomes: Iterable[str] = (paths.INCORRECT,)
) -> DataFrame:
    return images_of(objects, outcomes).filter(versions.is_earlier(F.col("version"), version))


def earlier_versions(objects: DataFrame, version: str) -> DataFrame:
    """Version directories a run may replay, with their number."""
    found = objects.select(paths.version_of(F.col("path")).alias("version")).filter(
        versions.is_earlier(F.col("version"), version)
    )
    return found.distinct().withColumn("minor", versions.directory_number(F.col("version")))


def replay_sample(
    objects: DataFrame,
    version: str,
    share: float = REPLAY_SHARE,
    seed: int = DEFAULT_SEED,
    outcomes: Iterable[str] = (paths.INCORRECT,),
) -> DataFrame:
    """Exactly ``int(n * share)`` images of each earlier version."""
    pool = earlier_images(objects, version, outcomes)
    return mark_share(pool, "path", share, by=["version"], seed=seed).filter("taken").drop("taken")


def pooled_sample(
    files: DataFrame,
    family: str,
    excluded: str,
    share: float = REPLAY_SHARE,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Exactly ``int(N * share)`` files of all versions of a family together.

    ``files`` has ``path`` and ``version``; ``family`` is a plain text prefix of the
    version directory.
    """
    pool = files.filter(
        F.startswith(F.col("version"), F.lit(family)) & (F.col("version") != excluded)
    )
    return mark_share(pool, "path", share, seed=seed).filter("taken").drop("taken")


def pooled_replay_sample(
    objects: DataFrame,
    family: str,
    excluded: str,
    share: float = REPLAY_SHARE,
    seed: int = DEFAULT_SEED,
    outcomes: Iterable[str] = (paths.CORRECT, paths.INCORRECT),
) -> DataFrame:
    """The pooled sample over images of both outcomes."""
    return pooled_sample(images_of(objects, outcomes), family, excluded, share, seed)


def training_paths(
    objects: DataFrame,
    version: str,
    share: float = REPLAY_SHARE,
    seed: int = DEFAULT_SEED,
    outcomes: Iterable[str] = (paths.INCORRECT,),
) -> DataFrame:
    """Images of the current version and the replayed ones, with their origin."""
    outcomes = list(outcomes)
    current = current_images(objects, version, outcomes).withColumn("origin", F.lit("current"))
    replay = replay_sample(objects, version, share, seed, outcomes).withColumn(
        "origin", F.lit("replay")
    )
    return current.unionByName(replay)
