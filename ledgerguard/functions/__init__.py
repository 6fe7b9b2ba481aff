from ledgerguard.functions.expressions import *  # noqa: F401,F403
from ledgerguard.functions.formatting import *  # noqa: F401,F403
