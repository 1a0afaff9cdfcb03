"""The jobs a user runs: index, neighbours, clusters and map, refresh.

Each job reads what the one before it stored, so a job can be repeated alone
and a lost executor never sends work back past the last stored table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.operators import clustering, neighbours, refresh, silhouette
from peerlens.operators.layer import map_layer
from peerlens.operators.rollup import removal_report
from peerlens.operators.standardise import as_vectors, standardise, statistics
from peerlens.plans import index as index_plan
from peerlens.plans.names import similarity_features
from peerlens.plans.organisations import is_english
from peerlens.sources.readers import read_snapshot
from peerlens.sources.sinks import write_csv, write_snapshot, write_snapshots
from peerlens.sources.staging import stage, staging_scope
from peerlens.sources.units import is_stored

LEVELS = ("practice", "pcn")
# Clusters per level and neighbours kept.
CLUSTERS = {"practice": 7, "pcn": 5}
NEIGHBOURS = 10
STARTS = 20


def conditions_of(spark: SparkSession, out: str) -> list[str]:
    """The condition columns, in order, as stored with the index."""
    rows = read_snapshot(spark, f"{out}/conditions").collect()
    return [r.condition for r in sorted(rows, key=lambda r: r.place)]


def build_index(spark: SparkSession, sources: index_plan.Sources, out: str) -> None:
    """Both index tables, as delimited text and as stored tables, and the removed-rows report."""
    report = removal_report(sources.registrations, is_english("lsoa11cd"))
    write_snapshot(report, f"{out}/quality/registrations")
    listed = [(i, c) for i, c in enumerate(sources.conditions)]
    write_snapshot(spark.createDataFrame(listed, "place int, condition string"), f"{out}/conditions")
    with staging_scope(spark, "index"):
        sums = index_plan.stored_area_sums(sources)
        tables = {
            "practice": index_plan.practice_table(sources, sums),
            "pcn": index_plan.parent_table(sources, sums),
        }
        write_snapshots(tables, f"{out}/nn_data")
    for level in tables:
        write_csv(read_snapshot(spark, f"{out}/nn_data/{level}"), f"{out}/{level}_level_nn_data")


def _feature_table(spark: SparkSession, out: str, level: str) -> tuple[DataFrame, list[str]]:
    index = read_snapshot(spark, f"{out}/nn_data/{level}")
    features = similarity_features(conditions_of(spark, out))
    return index.select("ORG_CODE", *features), features


def build_neighbours(spark: SparkSession, out: str, levels: Sequence[str] = LEVELS, with_pairs: bool = False) -> None:
    """Nearest and farthest lists; the full pair table only if asked for, as it is quadratic.

    The lists never come from the pair table: they keep k rows per block pair
    where the table has one per pair of organisations.  The vectors, the scale
    of their features and the reverse index are saved with the lists, as one
    unit, for ``update_neighbours``.
    """
    pairs, unit = {}, {}
    with staging_scope(spark, "neighbours"):
        for level in levels:
            table, features = _feature_table(spark, out, level)
            scale = stage(statistics(table, features), "scale")
            vectors = stage(as_vectors(standardise(table, ["ORG_CODE"], features, stats=scale), "ORG_CODE", features), "vectors")
            if with_pairs:
                pairs[level] = neighbours.pairwise_distance(vectors)
            lists = stage(neighbours.nearest_and_farthest(vectors, NEIGHBOURS), "lists")
            unit |= _neighbour_tables(level, lists, vectors, scale)
        if pairs:
            write_snapshots(pairs, f"{out}/dist_data", keep_others=True)
        write_snapshots(unit, f"{out}/dist_lists", keep_others=True)


def _neighbour_tables(level: str, lists: DataFrame, vectors: DataFrame, scale: DataFrame) -> dict[str, DataFrame]:
    return {
        level: lists,
        f"{level}_vectors": vectors,
        f"{level}_scale": scale,
        f"{level}_listed_by": refresh.reverse_index(lists),
    }


def update_neighbours(spark: SparkSession, out: str, levels: Sequence[str] = LEVELS) -> dict[str, refresh.Refreshed]:
    """The stored lists brought up to date with the stored index, at the scale of the last ``build_neighbours``.

    Only lists that organisations which came, went or changed can touch are
    worked on.  Says, for each level, how many lists were made anew and how many pairs compared.
    """
    done, unit = {}, {}
    with staging_scope(spark, "neighbours"):
        for level in levels:
            table, features = _feature_table(spark, out, level)
            scale, old, lists, listed_by = (
                read_snapshot(spark, f"{out}/dist_lists/{level}{part}") for part in ("_scale", "_vectors", "", "_listed_by")
            )
            now = stage(as_vectors(standardise(table, ["ORG_CODE"], features, stats=scale), "ORG_CODE", features), "vectors")
            done[level] = refresh.updated_lists(old, now, neighbours.with_rank(lists), NEIGHBOURS, reverse=listed_by)
            unit |= _neighbour_tables(level, stage(neighbours.placed(done[level].lists, NEIGHBOURS), "placed"), now, scale)
        write_snapshots(unit, f"{out}/dist_lists", keep_others=True)
    return done


def build_clusters(
    spark: SparkSession,
    out: str,
    levels: Sequence[str] = LEVELS,
    clusters: Mapping[str, int] = CLUSTERS,
    starts: int = STARTS,
    k_max: int = 10,
    diagnostics: bool = True,
) -> None:
    """Clusters and the map table, then the sweeps over k that justify them.

    All starts and all k of the sweep are fitted in the same passes.  The
    silhouettes compare all pairs, so the diagnostics come last and can be left out.
    """
    for level in levels:
        table, features = _feature_table(spark, out, level)
        with staging_scope(spark, "clusters"):
            points = stage(clustering.cluster_input(table, "ORG_CODE", features), "points")
            runs = [(clusters[level], 1 + i) for i in range(starts)]
            sweep = clustering.sweep_runs(k_max) if diagnostics else []
            fits = clustering.fit_all(points, [*runs, *sweep])
            labelled = clustering.labelled_by(points, clustering.best_of(fits[:starts]))
            write_snapshot(labelled.select(F.col("key").alias("ORG_CODE"), "cluster"), f"{out}/clusters/{level}")
            if level == "practice":
                index = read_snapshot(spark, f"{out}/nn_data/{level}")
                layer = map_layer(index, read_snapshot(spark, f"{out}/clusters/{level}"))
                write_snapshot(layer, f"{out}/map_layer", ["cluster"])
            if diagnostics:
                write_snapshot(silhouette.k_diagnostics(points, fits[starts:]), f"{out}/k_diagnostics/{level}")


def refresh_neighbours(spark: SparkSession, out: str, levels: Sequence[str] = LEVELS) -> None:
    """Nearest lists again, as stored table and text, from the stored pairs or, without these, the stored lists.

    They go to their own folder; what they are made from stays as it is.
    """
    for level in levels:
        if is_stored(spark, f"{out}/dist_data/{level}"):
            pairs = read_snapshot(spark, f"{out}/dist_data/{level}")
        else:
            lists = read_snapshot(spark, f"{out}/dist_lists/{level}")
            pairs = lists.filter(F.col("list") == "nearest").select("orig", "dest", "distance")
        path = f"{out}/dist_data_n10/{level}"
        write_snapshot(neighbours.nearest_from_pairs(pairs, NEIGHBOURS), path)
        write_csv(read_snapshot(spark, path), f"{out}/{level}_nearest")
