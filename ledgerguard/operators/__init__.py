from ledgerguard.operators.rules import (  # noqa: F401
    all_alerts, fraud_lake_rows, geo_flags, high_value_alerts, impossible_travel_tumbling, lake_date,
    tumbling_travel_keys, tumbling_travel_members, valid_excluding_travel, valid_transactions,
    with_window_start)
from ledgerguard.operators.travel import (  # noqa: F401
    impossible_travel_session, travel_hops, trailing_travel)
