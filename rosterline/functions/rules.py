"""Role rules as ordered data, and the tests on job titles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One branch of a classification. All given parts must hold.

    Patterns are lower-case LIKE bodies: 'sales%manager' means '%sales%manager%'.
    """

    label: str
    title: tuple[str, ...] = ()        # the title has each of these
    title_any: tuple[str, ...] = ()    # the title has one of these
    title_any2: tuple[str, ...] = ()   # ... and one of these
    title_none: tuple[str, ...] = ()   # the title has none of these
    title_is: tuple[str, ...] = ()     # the title is one of these
    area: tuple[str, ...] = ()         # the area has one of these
    ends_from: dt.date | None = None   # the version ends on this day or later

    def condition(self, title: str, area: str, valid_to: str) -> str:
        """The rule as an SQL condition on lower-case title and area."""
        parts = [_has(title, p) for p in self.title]
        parts += [_any(title, group) for group in (self.title_any, self.title_any2) if group]
        parts += [f"not {_has(title, p)}" for p in self.title_none]
        if self.title_is:
            parts.append(f"{title} in ({', '.join(map(_quoted, self.title_is))})")
        if self.area:
            parts.append(_any(area, self.area))
        if self.ends_from:
            parts.append(f"{valid_to} >= date'{self.ends_from}'")
        return " and ".join(parts)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    """A column name in SQL text, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def _has(col: str, pattern: str) -> str:
    return f"{col} like {_quoted(f'%{pattern}%')}"


def _any(col: str, patterns: Iterable[str]) -> str:
    return "(" + " or ".join(_has(col, p) for p in patterns) + ")"


SDR = "Sales Developer Representative"

# Role labels in the order in which they are tried.
ROLE_RULES: tuple[Rule, ...] = (
    Rule("CSO", title=("chief revenue officer",), area=("sales",)),
    Rule("Sales VP", title=("vp sales",), area=("sales",)),
    Rule("Sales Manager", title=("sales%manager",), area=("sales",)),
    Rule("Expansions Head", title=("expansions", "head")),
    Rule("Expansions Expert", title=("expansions",)),
    Rule("Sr Industry Head", title=("senior",), title_any=("leader", "head"),
         title_none=("sdr",), area=("sales",)),
    Rule("Industry Head", title_any=("leader", "head"), title_none=("sdr", "expansions"),
         area=("sales",)),
    Rule(SDR, title=("representative",), area=("sales", "sdr"), ends_from=dt.date(2021, 3, 1)),
    Rule(f"{SDR} Lead", title=("representative", "lead"), area=("sales", "sdr")),
    Rule(SDR, title=("representative",), area=("growth",)),
    Rule("SDR Head", title=("sdr", "head")),
    Rule("Sr Business Developer", title=("senior",), area=("sales",)),
    Rule("Jr Business Developer", title=("junior",), area=("sales",)),
    Rule("Intern Comercial", title=("intern",), area=("sales",)),
    Rule("Business Developer", area=("sales",)),
    Rule("Customer Success VP", title=("vp",), area=("customer",)),
    Rule("Customer Success Sr Manager", title_is=("customer success senior manager",),
         area=("customer",)),
    Rule("Student Success Manager", title_is=("student success manager",), area=("customer",)),
    Rule("Customer Experience Manager", title_is=("customer experience manager",),
         area=("customer",)),
    Rule("Customer Success Manager",
         title_is=("customer success manager", "customer sucess manager"), area=("customer",)),
    Rule("KAMs Head", title=("head",), title_any=("kam", "account"), area=("customer",)),
    Rule("Expansions Head", title=("head", "expansion"), area=("customer",)),
    Rule("Customer Success Head", title=("head",), area=("customer",)),
    Rule("Sr KAM", title_any=("sr", "senior"), title_any2=("kam", "account", "key"),
         area=("customer",)),
    Rule("KAM", title_any=("kam", "account", "key"), area=("customer",)),
    Rule("Expansions Expert", title=("expansions",), area=("customer",)),
)


def first_match(branches: Iterable[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first branch whose condition is true, else the default."""
    branches = list(branches)
    if not branches:
        return default
    (condition, value), *rest = branches
    folded = F.when(condition, value)
    for condition, value in rest:
        folded = folded.when(condition, value)
    return folded.otherwise(default)


def classify(title: str = "job_title", area: str = "area", valid_to: str = "valid_to",
             rules: Iterable[Rule] = ROLE_RULES, default: str = "Other") -> Column:
    """The label of the first rule that holds for the named columns.

    One SQL expression instead of a few hundred Column calls, each a round trip to the JVM.
    """
    title, area, valid_to = f"lower({_name(title)})", f"lower({_name(area)})", _name(valid_to)
    branches = " ".join(f"when {r.condition(title, area, valid_to)} then {_quoted(r.label)}"
                        for r in rules)
    return F.expr(f"case {branches} else {_quoted(default)} end")


def is_leader(title: str = "job_title") -> Column:
    """Leaders, heads, and managers other than key account managers."""
    title = f"lower({_name(title)})"
    return F.expr(f"{_any(title, ('leader', 'head'))} or "
                  f"({_has(title, 'manager')} and not {_has(title, 'key')})")


def manager_words(title: str = "job_title", area: str = "area") -> dict[str, Column]:
    """What the manager test asks of a title, worked out once per row.

    The test at a level is ``(manager or vp_unless_manager_below or head) and not key``. The
    flags stay null for a null title, so that a missing level never passes.
    """
    title, area = f"lower({_name(title)})", f"lower({_name(area)})"
    return {
        "says_manager": F.expr(_has(title, "manager")),
        "says_vp": F.expr(_has(title, "vp sales")),
        "other_head": F.expr(f"{_has(title, 'head')} and not {_any(area, ('sales', 'growth'))}"),
        "says_key": F.expr(_has(title, "key")),
    }
