from ledgerguard.sources.fixtures import transactions_from_events, read_table  # noqa: F401
from ledgerguard.sources.json_ingest import (  # noqa: F401
    encode_transactions, parse_transactions, split_malformed, screened_form)
from ledgerguard.sources.lakes import read_lake  # noqa: F401
