from trilode.operators.aggregate import (
    build_gold,
    fused_groups,
    group_table,
    metric_table,
    metrics,
    rows_of,
    top_n,
)
from trilode.operators.audit import audit_row, audit_summary, recent_runs
from trilode.operators.clean import (
    apply_rules,
    clean,
    clean_split,
    dedup,
    drop_nulls,
    fill_nulls,
    failure_bits,
    fix_types,
    judge,
    require_columns,
    select_columns,
    union_all,
)
from trilode.operators.quality import (
    bronze_contract,
    gold_contract,
    rejected_report,
    repeated_keys,
    row_accounting,
    rule_report,
    silver_contract,
)

__all__ = [
    "apply_rules", "audit_row", "audit_summary", "bronze_contract", "build_gold", "clean",
    "clean_split", "dedup", "drop_nulls", "failure_bits", "fill_nulls", "fix_types", "fused_groups", "gold_contract",
    "group_table", "judge", "metric_table", "metrics", "recent_runs", "rejected_report",
    "repeated_keys", "require_columns", "row_accounting",
    "rows_of", "rule_report", "select_columns", "silver_contract", "top_n", "union_all",
]
