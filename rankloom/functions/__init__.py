from .weights import EVENT_WEIGHTS, recode_expr, weight_expr
from .timecols import epoch_millis, year_start_millis
from .hashing import hash_bucket
from .vectors import dot_expr

__all__ = ["EVENT_WEIGHTS", "recode_expr", "weight_expr", "epoch_millis", "year_start_millis",
           "hash_bucket", "dot_expr"]
