from .columns import cap, flag_above, name_flag, ratio
from .stats import STATS, named_stat

__all__ = ["STATS", "cap", "flag_above", "name_flag", "named_stat", "ratio"]
