from strata.operators.keys import assign_keys, global_ntile, global_rank, prefix_positions, sort_exprs  # noqa: F401
from strata.operators.load import (  # noqa: F401
    append, full_refresh, insert_if_absent, latest_per_key, replace_partition,
    require_keys, scd1_upsert, scd2_upsert, split_required,
)
from strata.operators.joins import bounded_broadcast  # noqa: F401
