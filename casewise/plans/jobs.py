"""The jobs: cleaning, event log, training and comparison, each from tables to tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.functions.numeric import winner
from casewise.operators import cases, cleaning, dfg, labels, metrics, sampling, variants
from casewise.operators.event_log import bucket_activities, build_event_log, drop_segment
from casewise.operators.hierarchy import HierarchicalClassifier, evaluate_against_gold
from casewise.session import durable
from casewise.sources.tables import write_metrics, write_table


def clean_calls(
    calls: DataFrame,
    keep_scripts: bool = False,
    keep_all_query_types: bool = False,
    ord_col: str = "call_id",
    date_formats: Sequence[str] = (),
    deny: Sequence[str] = cleaning.NON_ADVISORY,
    scripts: Sequence[tuple[int, int]] = (cleaning.DEVANAGARI, cleaning.MALAYALAM),
    **scope_filters,
) -> DataFrame:
    """The cleaning job: clean, filter, scope, merge near-duplicate query types."""
    out = cleaning.basic_clean(calls, ord_col, date_formats)
    if not keep_all_query_types:
        out = cleaning.filter_to_advisory(out, deny=deny)
    if not keep_scripts:
        out = cleaning.filter_scripts(out, scripts=scripts)
    # labels are counted and then replaced: without this the rows would be de-duplicated twice
    out = durable(cleaning.scope(out, **scope_filters))
    return labels.merge_near_duplicate_labels(out, "query_type")


def discovery_log(log: DataFrame, n_activities: int = 8, k_variants: int | None = 15) -> DataFrame:
    """The log a readable model is discovered from: top activities, top variants."""
    bucketed = bucket_activities(log, n_activities)
    if not k_variants:
        return bucketed
    return variants.filter_top_variants(bucketed, durable(variants.variant_analysis(bucketed)), k_variants)


def event_log_job(
    calls: DataFrame, out_dir: str, activity_col: str, drop_others: bool = True, ord_col: str = "call_id"
) -> dict[str, DataFrame]:
    """Mine a clean call table and write every result table under ``out_dir``."""
    log = build_event_log(
        drop_segment(calls, "crop", enabled=drop_others), activity_col=activity_col, ord_col=ord_col
    )
    log = durable(log.select("case_id", "activity", "ts", "ord", "state", "crop", "season"))
    metrics_table = durable(cases.case_metrics(log))
    variant_table = durable(variants.variant_analysis(log))
    top = durable(variants.top_variants(variants.variant_counts(variant_table), 5))
    edges, nodes = dfg.discover_dfg(log)
    prepared = discovery_log(log)
    tables = {
        "loop_rate_per_case": metrics_table.select("case_id", "n_events", "n_repeats", "loop_rate", "crop", "state"),
        "case_durations": metrics_table.select("case_id", "duration_days", "n_events", "crop", "state"),
        "variants": variant_table,
        "variant_parts": variants.variant_parts(log),
        "summary_by_crop": cases.summarize_by_segment(metrics_table),
        "dfg_edges": edges,
        "dfg_nodes": nodes,
        "footprint": dfg.footprint(dfg.transitions(prepared)),
        "top_variants": variants.with_sequences(top, log).select("variant", F.col("n_cases").alias("n"), "variant_key"),
    }
    for name, table in tables.items():
        write_table(table, f"{out_dir}/{name}")
    return tables


def train_job(
    calls: DataFrame,
    model_dir: str,
    metrics_dir: str,
    id_col: str = "call_id",
    exclude_ids: DataFrame | None = None,
    seed: int = 42,
    **settings,
) -> tuple[HierarchicalClassifier, DataFrame]:
    """Rare categories merged, stratified split, fit, save, score on the held-out part.

    ``exclude_ids`` keeps gold calls out of the training rows.
    """
    usable = cleaning.merge_rare(calls.where(F.col("category").isNotNull()), "category")
    train, held_out = sampling.stratified_split(usable, "category", id_col, seed=seed)
    if exclude_ids is not None:
        train = train.join(exclude_ids.select(id_col).distinct(), id_col, "left_anti")
    model = HierarchicalClassifier(**settings).fit(train)
    model.save(calls.sparkSession, model_dir)
    scores = durable(evaluate_against_gold(model, held_out))
    write_metrics(scores, metrics_dir)
    return model, scores


def compare_methods(
    aligned: DataFrame, truth: str, extracted: str, signal_truth: str, signal_extracted: str, classified: str
) -> DataFrame:
    """Accuracy and macro-F1 of extraction and classifier on the same rows, and the winner.

    ``aligned`` has one row per gold call with the gold labels and both predictions.
    """
    pairs = {
        "extraction": (truth, extracted),
        "signal": (signal_truth, signal_extracted),
        "classifier": (truth, classified),
    }
    # one read of the rows: all three confusion tables come from it
    long = aligned.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("method"), F.col(t).alias("true_label"), F.col(p).alias("pred_label"))
                    for k, (t, p) in pairs.items()
                ]
            )
        )
    )
    counts = long.groupBy("method", "true_label", "pred_label").agg(F.count(F.lit(1)).alias("n"))
    result = None
    for name in pairs:
        own = metrics.per_class(counts.where(F.col("method") == name).drop("method")).agg(
            F.sum("support").alias(f"{name}_n"),
            (F.sum("n_correct") / F.sum("support")).alias(f"{name}_accuracy"),
            F.avg("f1").alias(f"{name}_macro_f1"),
        )
        result = own if result is None else result.withColumns(
            {c: own.select(c).scalar() for c in own.columns if not c.endswith("_n")}
        )
    return result.select(
        F.col("extraction_n").alias("n_compared"),
        F.col("extraction_accuracy"),
        F.col("extraction_macro_f1"),
        F.col("signal_accuracy"),
        F.col("classifier_accuracy"),
        F.col("classifier_macro_f1"),
        winner(F.col("extraction_accuracy"), F.col("classifier_accuracy"), "LLM extraction", "Baseline classifier").alias("winner"),
    )


def comparison_job(
    gold: DataFrame, extracted: DataFrame, model: HierarchicalClassifier, out_dir: str, id_col: str = "call_id",
    crosswalk: DataFrame | None = None,
) -> DataFrame:
    """L8 end to end: align, require labels, classify, compare, write.

    ``crosswalk`` (category, query_type) translates the extraction's coarse labels. The sizes
    of both sides and the gold rows without an extraction are columns of the result.
    """
    if crosswalk is not None:
        names = crosswalk.withColumnRenamed("query_type", "_to")
        extracted = extracted.join(names, "category", "left").withColumn(
            "category", F.coalesce("_to", "category")
        ).drop("_to")
    aligned = durable(metrics.align(gold, extracted, id_col))
    if aligned.isEmpty():
        raise ValueError(f"no common {id_col} between the gold set and the extraction")
    needed = ["gold_query_type", "gold_resolution_signal", "ext_resolution_signal", "ext_category"]
    labelled = model.predict(metrics.require_values(aligned, needed), "gold_question")
    out = durable(
        compare_methods(
            labelled, "gold_query_type", "ext_category", "gold_resolution_signal", "ext_resolution_signal",
            "pred_query_type",
        ).crossJoin(F.broadcast(metrics.align_audit(gold, extracted, id_col)))  # one row each
    )
    write_metrics(out, out_dir)
    return out
