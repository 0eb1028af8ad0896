"""High-utility itemset mining on Spark DataFrames."""

from .operators.mining import ENDPOINTS, EXACT, Mining, Mode, mine, mine_top
from .plans.run import Run, run, run_items
from .sources.tables import items_from
from .sources.text import read_transactions

__all__ = [
    "ENDPOINTS",
    "EXACT",
    "Mining",
    "Mode",
    "Run",
    "items_from",
    "mine",
    "mine_top",
    "read_transactions",
    "run",
    "run_items",
]
