"""Fixtures, text formats, model store and blob tables."""

from ridgeway._lazy import lazy_exports

_EXPORTS = {
    "HINGE_FEATURES": "ridgeway.sources.tables",
    "LIN_FEATURES": "ridgeway.sources.tables",
    "ModelStore": "ridgeway.sources.model_store",
    "THREE_BLOBS": "ridgeway.sources.blobs",
    "TrainingLog": "ridgeway.sources.training_log",
    "TWO_BLOBS": "ridgeway.sources.blobs",
    "blob_table": "ridgeway.sources.blobs",
    "class_rows": "ridgeway.sources.tables",
    "hinge_rows": "ridgeway.sources.tables",
    "lin_rows": "ridgeway.sources.tables",
    "log_rows": "ridgeway.sources.tables",
    "parse_weight_record": "ridgeway.sources.text",
    "read_csv_rows": "ridgeway.sources.text",
    "read_model": "ridgeway.sources.model_io",
    "read_labelled_text": "ridgeway.sources.text",
    "read_table": "ridgeway.sources.tables",
    "read_tsv_rows": "ridgeway.sources.text",
    "read_weight_lines": "ridgeway.sources.text",
    "read_weight_record": "ridgeway.sources.text",
    "stream_rows": "ridgeway.sources.tables",
    "union_class_tables": "ridgeway.sources.blobs",
    "weight_record_line": "ridgeway.sources.text",
    "write_labelled_text": "ridgeway.sources.text",
    "write_model": "ridgeway.sources.model_io",
    "write_weight_lines": "ridgeway.sources.text",
    "write_weight_record": "ridgeway.sources.text",
}

__getattr__, __dir__ = lazy_exports(__name__, _EXPORTS)
__all__ = sorted(_EXPORTS)
