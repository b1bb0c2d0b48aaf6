"""Sources: files (CSV/Parquet/any reader) and rule documents."""

from qualia.sources.files import load_df, load_survey_df, read_csv  # noqa: F401
from qualia.sources.rules import (  # noqa: F401
    DOCUMENT_SCHEMA,
    RULES_SCHEMA,
    documents_from_dicts,
    malformed_documents,
    read_rule_documents,
    rules_of,
    rules_table,
    select_rules,
)
