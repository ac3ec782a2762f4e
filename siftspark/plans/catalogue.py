"""All registered queries of the engine, with their SQL and what each covers."""

from __future__ import annotations

from siftspark.plans import queries, queries_formats, queries_more  # noqa: F401 - they register their queries
from siftspark.plans.registry import COVERS, ORACLES, QUERIES

#: Parts of the inventory that the queries of the first module cover.
COVERS |= {
    "ranked_hits": "J7 A1 A2 F11 F12 F17 F29 W1", "top_n_hits": "O1", "hit_summary": "A3", "kofn_property_vote": "P3", "conjunctive_endpoint_filter": "P5 J2 U9", "model_vote_filter": "P6 A8",
    "key_count_filter": "P7 J3", "rule_scores": "P11 F23", "survivor_filter": "P21", "consensus_vote": "P22", "pattern_reject": "P1 F4", "any_match": "P9 A25", "semi_join_filter": "J1", "anti_join_filter": "J15",
    "outer_vote_merge": "J8", "dedup_first": "A10 W2", "dedup_last": "A11 W2", "dedup_policy_keep_first": "A12", "dedup_policy_mean": "A12", "dedup_policy_remove_positive": "A12", "dedup_policy_remove_negative": "A12",
    "dedup_policy_remove_all": "A12", "dedup_policy_keep_all": "A12", "collection_union": "U1", "collection_intersect": "U2 U4", "collection_difference": "U3", "scaffold_topk": "A18", "label_stats": "A19",
    "desirability_score": "F14", "weighted_geomean": "A6", "zscore_sigmoid": "F13", "unit_conversion": "F16", "similarity_matrix": "J11 J16 F19", "mean_similarity_filter": "P8 A9", "nearest_neighbour": "J17 W3",
    "threshold_pairs": "J12 J13", "ambiguity_removal": "J14", "count_tanimoto": "F18", "butina_clusters": "G1 G2 O5", "bounding_box": "A20 F24", "pocket_box": "A21 P25", "range_contacts": "J18",
    "unordered_pair_count": "A23", "key_residue_counts": "A24 J19", "shard_allocation": "A14 A15", "split_sizes": "W4 M12", "split_hygiene": "U5", "group_kfold": "M6", "class_rebalance": "M8", "pr_curve": "W6",
    "roc_auc": "W7", "confusion_metrics": "A27", "cutoff_search": "A17", "recall_relaxation": "M14", "model_selection": "O6 M14", "hyper_grid": "J22", "slot_allocation": "F26 F9", "gpu_pick": "P26 O8",
    "progress_running_sum": "A29 T4", "progress_percent": "T3", "module_transitions": "T2", "log_tail": "W11 T5", "repeat_suppression": "W8", "streaming_tumbling": "extension", "streaming_sliding": "extension",
    "streaming_session": "extension", "early_stopping": "W10", "funnel": "P1 P3 P5 P6 P7",
}


def by_part() -> dict[str, list[str]]:
    """The queries that cover each part of the inventory."""
    out: dict[str, list[str]] = {}
    for name in QUERIES:
        for part in COVERS.get(name, "").split():
            out.setdefault(part, []).append(name)
    return out


__all__ = ["COVERS", "ORACLES", "QUERIES", "by_part"]
