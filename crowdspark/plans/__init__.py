"""The registered queries over the given tables, with their SQL."""

from importlib import import_module

MODULES = (
    "consensus_queries", "capture_queries", "classification_queries", "report_queries", "action_queries",
    "legacy_queries", "source_queries", "stream_queries",
)


def load_all() -> None:
    for module in MODULES:
        import_module(f"crowdspark.plans.{module}")
