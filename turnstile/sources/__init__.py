from .commits import Commits, commit_together
from .drops import DropFeed, fingerprint, positional_drops, unseen_files
from .files import Parted, append_rows, csv_scan, incremental_scan, land, load_by_name
from .ledgers import Ledger, Ledgers
from .tables import Draft, VersionedTable

__all__ = [
    "Commits", "Draft", "DropFeed", "Ledger", "Ledgers", "Parted", "VersionedTable", "append_rows",
    "commit_together", "csv_scan", "fingerprint", "incremental_scan", "land", "load_by_name",
    "positional_drops", "unseen_files",
]
