"""logscan: log anomaly detection expressed as Spark DataFrame plans.

Log lines are read from CSV folders (batch or stream), cleaned with native
column expressions, turned into hashed token vectors, scored by the
reconstruction error of a model trained on Spark, and filtered by an exact
percentile threshold.  Nothing is collected on the driver except bounded
model parameters and histogram summaries.

Main entry points::

    from logscan import read_logs, fit, save_model, load_model, detect, run_batch
    from logscan import start_detect_stream, exact_quantiles, error_summary
"""

from logscan.session import get_session, spread, work_dir

__all__ = [
    "get_session", "work_dir", "spread",
    "read_logs", "stream_logs", "write_csv",
    "prepare", "drop_incomplete", "mask_message", "parse_time", "compose_text",
    "Model", "make_scorer", "recon_error",
    "exact_quantiles", "error_summary", "threshold",
    "fit", "detect", "score_lines", "run_batch",
    "save_model", "load_model",
    "start_detect_stream", "start_catalogue", "decode_event", "latest_uploads",
]


def __getattr__(name):
    """Lazy access to the public API (keeps ``import logscan`` light)."""
    table = {
        "read_logs": "logscan.sources.logs", "stream_logs": "logscan.sources.logs",
        "write_csv": "logscan.sources.sinks",
        "prepare": "logscan.operators.prepare", "drop_incomplete": "logscan.operators.prepare",
        "mask_message": "logscan.functions.text", "parse_time": "logscan.functions.text",
        "compose_text": "logscan.functions.text",
        "Model": "logscan.operators.score", "make_scorer": "logscan.operators.score",
        "recon_error": "logscan.operators.score",
        "exact_quantiles": "logscan.operators.quantile",
        "error_summary": "logscan.operators.stats", "threshold": "logscan.operators.stats",
        "fit": "logscan.plans.fit", "detect": "logscan.plans.detect",
        "score_lines": "logscan.plans.detect", "run_batch": "logscan.plans.detect",
        "save_model": "logscan.sources.model_store", "load_model": "logscan.sources.model_store",
        "start_detect_stream": "logscan.streaming.detect_stream",
        "start_catalogue": "logscan.streaming.uploads_stream",
        "decode_event": "logscan.operators.uploads", "latest_uploads": "logscan.operators.uploads",
    }
    if name in table:
        import importlib

        return getattr(importlib.import_module(table[name]), name)
    raise AttributeError(f"module 'logscan' has no attribute {name!r}")
