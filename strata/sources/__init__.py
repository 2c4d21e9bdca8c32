from strata.sources.raw import (  # noqa: F401
    SOURCES, STAGES, land, lift_keys, read_csv_raw, read_json_raw, read_parquet_raw,
    split_bad, with_batch, with_lineage,
)
