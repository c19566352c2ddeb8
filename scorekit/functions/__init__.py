"""Column expressions and fixed names shared by the operators."""

from scorekit.functions.expressions import complete_case, or_fail, ratio
from scorekit.functions.names import FEATURES, TARGET

__all__ = ["FEATURES", "TARGET", "complete_case", "or_fail", "ratio"]
