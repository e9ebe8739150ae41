from trilode.plans.config import flow_from_config
from trilode.plans.domains import DOMAINS, fintech, iot, sales, web_logs
from trilode.plans.gold import read_output, read_outputs, write_gold
from trilode.plans.run import LayerResult, read_rescued, run

__all__ = [
    "DOMAINS", "LayerResult", "fintech", "flow_from_config", "iot", "read_output", "read_outputs",
    "read_rescued", "run", "sales", "web_logs", "write_gold",
]
