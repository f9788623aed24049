"""Queries over the operators of this subpackage, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from examloom.llm import canon, mix, mojibake, quality, scan, split, tokens, variants
from examloom.session import spread, table

Query = Callable[[SparkSession, str], DataFrame]


def _heavy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that come out in several pieces."""
    return split.split_oversized(table(spark, sf_dir, "get_headers")).where("n_pieces > 1 AND piece_no = 1").select("topic_id")


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_oversized(table(spark, sf_dir, "get_headers"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "get_headers_v1"))


def _entered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = table(spark, sf_dir, "extract_toc").selectExpr("'extract_toc' AS source_table", "toc_id AS row_id", "'topic' AS field", "topic AS name")
    ratings = table(spark, sf_dir, "get_ratings").selectExpr("'get_ratings' AS source_table", "rating_id AS row_id", "'rating_name' AS field", "rating_name AS name")
    return topics.unionAll(ratings)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.map_names(_entered_names(spark, sf_dir), table(spark, sf_dir, "canon_names")).select("source_table", "row_id", "canon_id")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names that mean no entry."""
    return canon.resolve(_entered_names(spark, sf_dir).select("field", "name"), table(spark, sf_dir, "canon_names")).where("canon_id = 0").select("field", "name")


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.repair(_heavy(spark, sf_dir, "get_headers"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_repaired(spark, sf_dir).where("garbled").select("topic_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.find(_heavy(spark, sf_dir, "get_headers"), _heavy(spark, sf_dir, "extract_toc")).where("noisy").select("source_table", "row_id")


def p6_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.repair(_heavy(spark, sf_dir, "get_headers"), _heavy(spark, sf_dir, "extract_toc"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_heavy(spark, sf_dir, "documents"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each record is used."""
    return mix.mix(_heavy(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(_heavy(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def _common(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """The frequent words, a fixed list, with a bit for each language."""
    rows = sorted((r.lang or "", r.word) for r in table(spark, sf_dir, "common_words").distinct().collect() if r.word)
    bits = {lang: 1 << i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in rows))}
    out: dict[str, int] = {}
    for lang, word in rows:
        out[word] = out.get(word, 0) | bits[lang]
    return out


def p9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_heavy(spark, sf_dir, "documents"), _common(spark, sf_dir))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_quality(spark, sf_dir).where("no_prose").select("doc_id")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_pieces, p2_found, p4_found, p4_unmatched, p5_found, p5_repaired, p6_found, p6_repaired, p7_ids, p8_mix, p8_shares, p9_found, p9_quality)}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": "SELECT topic_id FROM get_headers WHERE length(topic_text) > 32000"}
