"""The queries of this subpackage over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import p1_lines, p2_neighbours, p3_split, p4_near, p5_quality, p6_scans, p7_encode, p8_leaks, p9_repeats
from foliant.runtime import table


def _on(name: str, f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(table(spark, d, name))


def _both(f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(table(spark, d, "document_content"), table(spark, d, "embedding_table"))


def _and(other: str, f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(table(spark, d, "document_content"), table(spark, d, other))


def _leaks(f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(spark, table(spark, d, "documents"), table(spark, d, "eval_items"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": _on("document_content", p1_lines.repeated_lines),
        "p1_clean": _on("document_content", p1_lines.clean),
        "p1_clusters": _on("document_content", p1_lines.clusters_report),
        "p2_found": _on("embedding_table", p2_neighbours.pairs),
        "p2_nearest": _on("embedding_table", p2_neighbours.nearest),
        "p3_found": _both(lambda a, b: p3_split.oversized(p3_split.items(a, b))),
        "p3_pieces": _both(lambda a, b: p3_split.pieces(p3_split.items(a, b))),
        "p4_found": _both(p4_near.pairs),
        "p4_groups": _both(p4_near.groups),
        "p4_links": _both(p4_near.links),
        "p5_found": _and("common_words", p5_quality.found),
        "p5_quality": _and("common_words", p5_quality.quality),
        "p6_found": _and("document", p6_scans.found),
        "p6_noise": _and("document", p6_scans.noise),
        "p6_repaired": _and("document", p6_scans.repaired),
        "p7_ids": _on("documents", p7_encode.encode),
        "p7_round_trip": _on("documents", p7_encode.round_trip),
        "p8_found": _leaks(p8_leaks.leaks),
        "p8_spans": _leaks(p8_leaks.leak_spans),
        "p8_clean": _leaks(p8_leaks.clean),
        "p9_found": _on("documents", p9_repeats.found),
        "p9_shares": _on("documents", p9_repeats.shares),
    }
