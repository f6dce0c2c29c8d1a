"""The query catalogue: name -> function of (spark, table folder)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import clean_date
from ..functions.text import unify_yes_no
from ..operators import (
    anomalies, checks, frequency, health, impute, metadata, missing_map, normalise, profile, quality,
    rules, sketches, visual,
)
from ..operators.columns import numeric_columns
from ..operators.facts import collect_facts, column_facts
from ..operators.quantiles import numeric_cells
from ..sources.arrivals import deliveries, replay
from ..sources.csv import mark_missing, promote_types, read_csv, write_csv
from ..sources.dirty import dirty_customers, plant_faults
from ..sources.reports import read_report, write_report
from ..sources.synthetic import inject_issues, synthetic_customers
from ..sources.tables import read_table
from ..storage import scratch
from ..streaming.dedup import dedup_results, dedup_stream
from ..streaming.gate import check_stream, stream_results
from ..streaming.quality import quality_stream, quality_windows
from .clean import clean_scores, clean_table
from .gate import gate_summary
from .profile import report_digest
from .validate import anomaly_summary, build_contract

Query = Callable[[SparkSession, str], DataFrame]


def _of(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A query on one table; ``dirty`` is the customer table with planted faults."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        if table == "dirty":
            return operator(dirty_customers(spark, folder))
        return operator(read_table(spark, folder, table))

    return run


def _from_facts(operator: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: operator(column_facts(df))


def _profiled(df: DataFrame) -> dict:
    return metadata.profile_of(column_facts(df))


def _mixed_types(df: DataFrame) -> DataFrame:
    return metadata.mixed_types(df, collect_facts(df))


def _formats(df: DataFrame) -> dict[str, str]:
    return rules.format_columns(column_facts(df))


def _tokens(df: DataFrame) -> DataFrame:
    """Text columns with reader tokens for missing values, some of them numeric."""
    return df.selectExpr(
        "cast(o_orderkey as string) as order_key",
        "case o_custkey % 11 when 0 then 'NA' when 1 then 'null' when 2 then '' when 3 then 'n/a'"
        " else o_orderstatus end as status",
        "if(o_custkey % 7 = 0, '#N/A', cast(o_custkey as string)) as customer",
        "case when o_orderkey % 5 = 0 then 'nan' when o_orderkey % 2 = 0 then '0.5'"
        " else '2' end as share",
        "if(o_orderkey % 3 = 0, 'True', 'False') as flag",
    )


def _csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "csv")
    write_csv(_tokens(read_table(spark, folder, "orders")), path)
    return read_csv(spark, path)


def _report_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "report")
    facts = collect_facts(dirty_customers(spark, folder))
    write_report({"metadata": metadata.column_metadata(facts)}, path)
    return read_report(
        spark, path, "metadata",
        "column_name string, data_type string, inferred_type string, semantic_type string,"
        " is_mixed boolean",
    )


def _clean(df: DataFrame) -> DataFrame:
    return clean_table(df, _profiled(df)).table


def _clean_scores(df: DataFrame) -> DataFrame:
    known = _profiled(df)
    return clean_scores(df, clean_table(df, known), known)


def _check_formats(df: DataFrame) -> DataFrame:
    known = _profiled(df)
    cleaned = clean_table(df, known).table
    return checks.run_checks(cleaned, checks.format_checks(cleaned, known))


def _check_range(df: DataFrame) -> DataFrame:
    cleaned = _clean(df)
    return checks.run_checks(cleaned, checks.range_checks(cleaned, checks.numeric_bounds(df)))


def _check_negatives(df: DataFrame) -> DataFrame:
    cleaned = _clean(df)
    return checks.run_checks(cleaned, checks.negative_checks(cleaned))


def _allowed_values(df: DataFrame) -> DataFrame:
    return checks.allowed_values(df, checks.low_cardinality(_profiled(df)))


def _check_membership(df: DataFrame) -> DataFrame:
    """The raw rows against the categories of the cleaned ones."""
    known = _profiled(df)
    cleaned = clean_table(df, known).table
    allowed = checks.allowed_values(cleaned, checks.low_cardinality(known))
    return checks.run_checks(df, checks.membership_checks(allowed))


def _contract(df: DataFrame) -> tuple[DataFrame, list[checks.Check]]:
    known = _profiled(df)
    cleaned = clean_table(df, known).table
    return cleaned, build_contract(cleaned, known, checks.numeric_bounds(df))


def _validate(df: DataFrame) -> DataFrame:
    cleaned, contract = _contract(df)
    return checks.run_checks(cleaned, contract)


def _health_by_fences(df: DataFrame) -> DataFrame:
    cleaned, contract = _contract(df)
    return health.health_score(
        checks.run_checks(cleaned, contract), visual.rows_within_fences(cleaned)
    )


def _health_by_forest(df: DataFrame) -> DataFrame:
    cleaned, contract = _contract(df)
    _, free = anomaly_summary(cleaned)
    return health.health_score(checks.run_checks(cleaned, contract), free)


def _anomalies(df: DataFrame) -> DataFrame:
    flagged, _ = anomalies.detect_anomalies(df)
    return flagged.withColumn(anomalies.SCORE, F.round(anomalies.SCORE, 6))


def _planted_anomalies(df: DataFrame) -> DataFrame:
    """Three rows far out among the line items: all are flagged, by rank within five percent."""
    numbers = df.select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    far = df.sparkSession.range(3).selectExpr(
        "double(1000 + id) as l_quantity", "double(-9e6) as l_extendedprice",
        "double(7 + id) as l_discount", "double(-5) as l_tax")
    flagged, _ = anomalies.detect_anomalies(numbers.unionByName(far))
    return flagged.selectExpr(
        "count(*) as rows_scored", "count_if(is_anomaly and l_quantity >= 1000) as planted_flagged",
        "count_if(is_anomaly) <= ceil(0.05 * count(*)) as within_share")


def _stream_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The customers as a stream, checked against the cleaned table's contract."""
    _, contract = _contract(dirty_customers(spark, folder))
    schema = read_table(spark, folder, "customer").schema
    arriving = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .parquet(f"{folder}/customer.parquet*")
    )
    path = scratch(spark, "stream")
    check_stream(plant_faults(arriving), contract, path).awaitTermination()
    return stream_results(spark, path)


def _stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The events as late and repeated deliveries, each let through once."""
    arriving = deliveries(read_table(spark, folder, "events"))
    path = scratch(spark, "stream")
    replay(arriving, path, lambda rows: dedup_stream(
        rows, ["event_id"], "ts", "1 hour", path, salt=4))
    return dedup_results(spark, path, arriving.drop("delivery").schema).drop("ts")


def _stream_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Closed days of the same deliveries, held to the categories and bounds of the event table."""
    events = read_table(spark, folder, "events")
    contract = [
        *checks.range_checks(events.select("value"), checks.numeric_bounds(events, ["value"])),
        checks.Check("value", "negatives"),
        *checks.membership_checks(checks.allowed_values(events, ["event_type"])),
    ]
    path = scratch(spark, "stream")
    replay(deliveries(events), path, lambda rows: quality_stream(
        rows, contract, "ts", "1 day", "1 hour", path))
    return quality_windows(spark, path).selectExpr(
        "date_format(window_start, 'yyyy-MM-dd') as day", "column_name", "n_rows", "missing", "invalid")


def _with_infinity(df: DataFrame) -> DataFrame:
    """One column with an infinite value among its largest."""
    return df.selectExpr(
        "if(l_linenumber = 7, double('Infinity'), l_quantity) as l_quantity", "l_tax")


def _wide(df: DataFrame) -> DataFrame:
    """Fourteen numeric columns, the last one with values far out."""
    return df.selectExpr(
        *[f"l_quantity + {i} as c{i}" for i in range(13)],
        "if(l_orderkey % 500 = 0, 1e6, l_tax) as c13")


def _long_contacts(df: DataFrame) -> DataFrame:
    """Broken addresses of more than 64 characters with a common beginning."""
    return df.selectExpr(
        "concat(repeat('long address ', 6), lpad(string(c_custkey * 7919 % 100003), 6, '0'))"
        " as contact")


def _approx_within(df: DataFrame) -> DataFrame:
    """Whether each estimate is within three standard errors of the exact count."""
    approx = profile.cardinality_approx(df).select("column_name", "unique_values")
    exact = profile.cardinality(column_facts(df)).select(
        "column_name", F.col("unique_values").alias("exact"))
    return approx.join(exact, "column_name").selectExpr(
        "column_name", "abs(unique_values - exact) <= 1 + 0.06 * exact as within")


def _sketched_within(df: DataFrame) -> DataFrame:
    """Quantiles of sketches of three batches, merged: whether their ranks are within the bound."""
    batches = [
        sketches.quantile_sketches(df.filter(f"pmod(xxhash64(l_orderkey), 3) = {i}")) for i in range(3)]
    merged = sketches.merge_sketches(batches[0].union(batches[1]).union(batches[2]))
    asked = sketches.sketch_quantiles(merged, (0.01, 0.25, 0.5, 0.75, 0.99))
    values = numeric_cells(df, numeric_columns(df))
    ranks = values.join(F.broadcast(asked), "column_name").groupBy("column_name", "probability").agg(
        F.expr("count_if(v < value) / count(*)").alias("below"),
        F.expr("count_if(v <= value) / count(*)").alias("upto"))
    error = sketches.RANK_ERROR
    return ranks.selectExpr(
        "column_name", "probability",
        f"below - {error}D <= probability and probability <= upto + {error}D as within")


def _sampled_ratios(df: DataFrame) -> DataFrame:
    return sketches.sampled_ratios(sketches.value_sample(df))


def _with_gaps(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "l_orderkey", "l_linenumber", "if(l_quantity > 45, null, l_quantity) as l_quantity",
        "if(l_orderkey % 7 = 0, null, l_returnflag) as l_returnflag",
        "if(l_linenumber = 3, double('NaN'), l_tax) as l_tax")


def _density(df: DataFrame) -> DataFrame:
    """Digits beyond the twelfth are the order of summation."""
    return visual.density_curve(df).selectExpr(
        "column_name", "float(x) as x", "float(density) as density")


def _documents(df: DataFrame) -> DataFrame:
    return df.select("text", "lang", "source")


QUERIES: dict[str, Query] = {
    # sources
    "dirty_view": _of("dirty", lambda df: df),
    "na_tokens": _of("orders", lambda df: promote_types(mark_missing(_tokens(df)))),
    "csv_scan": _csv_scan,
    "report_roundtrip": _report_roundtrip,
    "dataset_summary": _of("dirty", lambda df: profile.dataset_summary(df, "customer")),
    "dataset_summary_lineitem": _of("lineitem", profile.dataset_summary),
    "dataset_summary_supplier": _of("supplier", lambda df: profile.dataset_summary(df, "supplier")),
    "top_values_pages": _of("pages", lambda df: frequency.top_values(df, ["url", "html"])),
    "top_values_conversations": _of("conversations", frequency.top_values),
    "top_values_nation": _of("nation", frequency.top_values),
    "top_values_region": _of("region", frequency.top_values),
    "column_metadata_customer": _of("customer", _from_facts(metadata.column_metadata)),
    "numeric_distribution_infinite": _of("lineitem", lambda df: profile.numeric_distribution(
        _with_infinity(df))),
    "outliers_iqr_wide": _of("lineitem", lambda df: visual.outliers_iqr(_wide(df))),
    "invalid_examples_long": _of("customer", lambda df: rules.invalid_examples(
        _long_contacts(df), {"contact": "email"})),
    "cardinality_approx_bounded": _of("lineitem", _approx_within),
    "synthetic_customers": _of(
        "customer", lambda df: inject_issues(synthetic_customers(df, "c_custkey"))
    ),
    "synthetic_customer_ids": _of("customer", lambda df: synthetic_customers(
        df, "c_custkey").selectExpr("customer_id", "nps_score between 0 and 10 as score_in_range")),
    # metadata
    "match_ratios": _of("dirty", _from_facts(metadata.match_ratios)),
    "infer_types": _of("dirty", _from_facts(metadata.infer_types)),
    "semantic_types": _of("dirty", _from_facts(metadata.semantic_types)),
    "mixed_types": _of("dirty", _mixed_types),
    "column_metadata": _of("dirty", _from_facts(metadata.column_metadata)),
    "column_metadata_lineitem": _of("lineitem", _from_facts(metadata.column_metadata)),
    "column_metadata_orders": _of("orders", _from_facts(metadata.column_metadata)),
    "column_metadata_part": _of("part", _from_facts(metadata.column_metadata)),
    "column_metadata_events": _of("events", _from_facts(metadata.column_metadata)),
    "column_metadata_documents": _of("documents", _from_facts(metadata.column_metadata)),
    "column_metadata_labels": _of("labels", _from_facts(metadata.column_metadata)),
    "column_metadata_embeddings": _of("embeddings", _from_facts(metadata.column_metadata)),
    "expected_types": _of("dirty", _from_facts(metadata.expected_types)),
    # profile
    "missing_per_column": _of("dirty", profile.missing_per_column),
    "missing_overall": _of("dirty", profile.missing_overall),
    "type_consistency": _of("dirty", _from_facts(profile.type_consistency)),
    "cardinality": _of("dirty", _from_facts(profile.cardinality)),
    "cardinality_lineitem": _of("lineitem", _from_facts(profile.cardinality)),
    "cardinality_documents": _of("documents", _from_facts(profile.cardinality)),
    "cardinality_approx": _of("lineitem", profile.cardinality_approx),
    "correlation_matrix": _of("lineitem", profile.correlation_matrix),
    "correlation_matrix_dirty": _of("dirty", profile.correlation_matrix),
    "correlation_tiled": _of("lineitem", lambda df: profile.correlation_matrix(df, tile=3)),
    "numeric_distribution": _of("lineitem", profile.numeric_distribution),
    "numeric_distribution_dirty": _of("dirty", profile.numeric_distribution),
    "numeric_distribution_events": _of("events", profile.numeric_distribution),
    "sketched_quantiles_bounded": _of("lineitem", _sketched_within),
    "sampled_ratios": _of("dirty", _sampled_ratios),
    "sampled_ratios_documents": _of("documents", _sampled_ratios),
    "top_values": _of("dirty", frequency.top_values),
    "top_values_lineitem": _of("lineitem", frequency.top_values),
    "top_values_documents": _of("documents", frequency.top_values),
    # rules
    "pii_columns": _of("dirty", _from_facts(rules.pii_columns)),
    "pii_columns_part": _of("part", _from_facts(rules.pii_columns)),
    "invalid_formats": _of("dirty", _from_facts(rules.invalid_formats)),
    "invalid_examples": _of("dirty", lambda df: rules.invalid_examples(df, _formats(df))),
    "invalid_rows": _of("dirty", lambda df: rules.invalid_rows(df, _formats(df))),
    "date_shapes": _of("dirty", _from_facts(rules.date_shapes)),
    "suspicious_columns": _of("dirty", _from_facts(rules.suspicious_columns)),
    "report_digest": _of("dirty", _from_facts(report_digest)),
    # chart data
    "missing_patterns": _of("dirty", visual.missing_patterns),
    "missing_map": _of("lineitem", lambda df: missing_map.missing_map(
        _with_gaps(df), ["l_orderkey", "l_linenumber"])),
    "histogram": _of("lineitem", visual.histogram),
    "boxplot_stats": _of("lineitem", visual.boxplot_stats),
    "boxplot_stats_dirty": _of("dirty", visual.boxplot_stats),
    "outliers_iqr": _of("dirty", visual.outliers_iqr),
    "density_curve": _of("customer", _density),
    "density_curve_lineitem": _of("lineitem", _density),
    # cleaning
    "quality_score": _of("dirty", quality.quality_score),
    "quality_score_validity": _of("dirty", lambda df: quality.quality_score(df, _profiled(df))),
    "quality_score_documents": _of("documents", lambda df: quality.quality_score(_documents(df))),
    "dedup_exact": _of("dirty", quality.drop_duplicates),
    "dedup_documents": _of("documents", lambda df: quality.drop_duplicates(_documents(df))),
    "dedup_in_place": _of("dirty", quality.drop_duplicates_in_place),
    "dedup_in_place_documents": _of(
        "documents", lambda df: quality.drop_duplicates_in_place(_documents(df))),
    "dedup_log": _of("dirty", quality.dedup_log),
    "dedup_log_documents": _of("documents", lambda df: quality.dedup_log(_documents(df))),
    "fix_numeric_text": _of(
        "dirty",
        lambda df: df.selectExpr(
            "customer_id", f"{normalise.numbers_from_text('monthly_charges')} as monthly_charges"
        ),
    ),
    "fix_dates": _of(
        "dirty",
        lambda df: df.selectExpr("customer_id", f"{clean_date('install_date')} as install_date"),
    ),
    "fix_yes_no": _of(
        "dirty", lambda df: df.selectExpr("customer_id", f"{unify_yes_no('churn')} as churn")
    ),
    "flag_phone": _of(
        "dirty",
        lambda df: df.selectExpr("customer_id", f"{normalise.flag_invalid_phone('phone')} as phone"),
    ),
    "normalise": _of("dirty", lambda df: normalise.normalise(df, _profiled(df))[0]),
    "normalise_log": _of("dirty", lambda df: normalise.normalise(df, _profiled(df))[1]),
    "impute": _of("dirty", lambda df: impute.impute(df, _profiled(df))[0]),
    "impute_log": _of("dirty", lambda df: impute.impute(df, _profiled(df))[1]),
    "impute_by_type": _of("dirty", lambda df: impute.impute(df)[0]),
    "clean_pipeline": _of("dirty", _clean),
    "clean_scores": _of("dirty", _clean_scores),
    # validation
    "check_email": _of("dirty", lambda df: checks.run_checks(df, checks.email_checks(df))),
    "check_formats": _of("dirty", _check_formats),
    "check_range": _of("dirty", _check_range),
    "check_negatives": _of("dirty", _check_negatives),
    "allowed_values": _of("dirty", _allowed_values),
    "check_membership": _of("dirty", _check_membership),
    "validate_pipeline": _of("dirty", _validate),
    "health_score": _of("dirty", _health_by_fences),
    "health_score_forest": _of("dirty", _health_by_forest),
    "anomalies_iforest": _of("lineitem", _anomalies),
    "anomalies_planted": _of("lineitem", _planted_anomalies),
    "stream_gate": _stream_gate,
    "stream_dedup": _stream_dedup,
    "stream_quality": _stream_quality,
    # the whole gate
    "gate_summary": _of("dirty", gate_summary),
    # all but what the forest decides
    "gate_counts": _of("dirty", lambda df: gate_summary(df).select(
        "rows_before", "rows_after", "exact_duplicates_removed", "missing_before",
        "missing_after", "quality_before", "quality_after", "quality_delta", "pass_rate")),
}
