from pawnshop.sources.files import (  # noqa: F401
    align_bucketed, align_by_key, align_by_ordinal, alignment_report, csv_multiline, csv_positional_schema,
    drop_header_rows, read_games, read_parquet, with_ordinal, with_source, write_bucketed, write_json, write_parquet,
)
