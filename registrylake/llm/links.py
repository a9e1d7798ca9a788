"""Classes of records that are connected by links, by repeated star joins.

Each round points every record to the smallest record it is linked with, first over larger, then over smaller neighbours.
All steps are joins and combinable aggregates; a round's links are written to the shared folder, so lineage stays short
and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.session import materialise

MAX_ROUNDS = 100


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): every pair with the smallest record that u is paired with."""
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")


def _pairs(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row (u, v) for each of ``pairs`` of columns of each row, in one pass over the rows."""
    each = F.explode(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs]))
    return rows.select(each.alias("pair")).select("pair.u", "pair.v")


def _large_star(links: DataFrame) -> DataFrame:
    both = _pairs(links, ("u", "v"), ("v", "u"))
    found = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return found.where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # links point from the larger to the smaller record
    return _pairs(_least(links), ("u", "m"), ("v", "m")).where("u <> v").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every record with a link to a smaller one has only that link, which no star join changes."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up")), F.struct(F.col("v").alias("id"), F.lit(0).alias("up")))).alias("end"))
    counts = ends.groupBy("end.id").agg(F.sum("end.up").alias("up"), F.count(F.lit(1)).alias("n"))
    return counts.where("up > 0 AND n > 1").count() == 0


def classes(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, class_id): the smallest record of the class, for every record with a link to another."""
    small, large = F.least(a, b), F.greatest(a, b)
    links = materialise(links.where(F.col(a) != F.col(b)).select(large.alias("u"), small.alias("v")).distinct(), "links")
    for _ in range(MAX_ROUNDS):
        if _settled(links):
            break
        links = materialise(_small_star(_large_star(links)), "links")
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    # every link now points to the smallest record of its class
    return links.select(F.col("u").alias("id"), F.col("v").alias("class_id")).unionByName(
        links.select(F.col("v").alias("id"), F.col("v").alias("class_id"))
    ).distinct()
