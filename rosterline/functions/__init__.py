from .dates import age, fractional_months, month_diff, weeks_between
from .names import fold_accents, name_key, null_if
from .rules import ROLE_RULES, Rule, classify, first_match, is_leader, manager_words

__all__ = [
    "ROLE_RULES", "Rule", "age", "classify", "first_match", "fold_accents", "fractional_months",
    "is_leader", "manager_words", "month_diff", "name_key", "null_if", "weeks_between",
]
