"""trilode: declarative Bronze -> Silver -> Gold batch and file-stream flows on Spark."""

from trilode.plans.config import flow_from_config
from trilode.plans.run import LayerResult, run
from trilode.spec import (
    AggSpec,
    CatalogSource,
    CleaningSpec,
    DatabaseSource,
    EventSource,
    FileSource,
    FlowSpec,
    GroupSpec,
    IncrementSpec,
    MetricSpec,
    RuleSpec,
    SinkSpec,
    layer_path,
)

__all__ = [
    "AggSpec",
    "CatalogSource",
    "CleaningSpec",
    "DatabaseSource",
    "EventSource",
    "FileSource",
    "FlowSpec",
    "GroupSpec",
    "IncrementSpec",
    "LayerResult",
    "MetricSpec",
    "RuleSpec",
    "SinkSpec",
    "flow_from_config",
    "layer_path",
    "run",
]
