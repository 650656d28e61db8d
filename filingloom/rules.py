"""Category rules and report codes.

The rule list is data: pass your own list wherever ``rules`` is a parameter. Patterns are Java
regular expressions, searched without regard to case.
"""

from typing import NamedTuple


class Rule(NamedTuple):
    category: str
    headline: str | None = None
    body: str | None = None


# Categories in order of precedence, with the patterns looked for in the headline.
CATEGORY_RULES = [
    Rule("Investor Presentation", headline="presentation"),
    Rule("Annual Report", headline="annual report"),
    Rule("Credit Rating", headline="credit rating"),
    Rule("Earnings Call Transcript", headline="earnings call|conference call|transcript"),
]

# Report type -> code used inside report ids.
REPORT_CODES = {
    "Investor Presentation": "IP",
    "Annual Report": "AR",
    "Credit Rating": "CR",
    "Earnings Call Transcript": "ECT",
}

# Fixed value: category of an announcement no rule matches.
DEFAULT_CATEGORY = "General"
