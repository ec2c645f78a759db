"""DataFrame -> DataFrame building blocks of a warehouse load."""

from starload.operators.dims import build_dimension, date_dim, dedupe_on_key, split_hierarchy
from starload.operators.keys import assign_surrogate_keys, assign_surrogate_keys_incremental
from starload.operators.layout import clustered, clustered_write
from starload.operators.lookup import (anti_members, date_lookup, dim_lookup, join_on_keys,
                                       missing_dim_default, semi_members)
from starload.operators.mapping import (add_audit_column, conform_schema, default_fill_rules, fill_nulls,
                                        map_columns, schema_differences)
from starload.operators.nest import collect_set_by_key, listagg_ordered, nest_children
from starload.operators.profile import (cluster_advice, distinct_counts, fk_containment, functional_dependency,
                                        infer_types, numeric_measures, table_profile)
from starload.operators.quality import (LoadCheckError, annotate_rejects, check_violations, count_checks, enforce,
                                        fk_orphans, not_null_check, null_key_check, reject_split,
                                        self_fk_orphans, unique_check, unresolved_fk_check)
from starload.operators.reconcile import reconcile, reconcile_rows, set_difference_counts

__all__ = [n for n in dir() if not n.startswith("_")]
