from .csv_tables import load_order_lists, load_tables, scan_csv
from .datasets import (
    cached,
    load_dataset,
    sample_rows,
    save_dataset,
    submission_name,
    write_ground_truth,
    write_scored_submission,
    write_submission,
)
from .store import Ledger, Store, store_tables

__all__ = [
    "Ledger",
    "Store",
    "cached",
    "load_dataset",
    "load_order_lists",
    "load_tables",
    "sample_rows",
    "save_dataset",
    "scan_csv",
    "store_tables",
    "submission_name",
    "write_ground_truth",
    "write_scored_submission",
    "write_submission",
]
