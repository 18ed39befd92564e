"""Compile rule tables to one SQL conditional; the first match wins.

Rules become SQL text, parsed once per field by Spark.  Conditions use SQL
logic: a comparison with NULL is neither true nor false, so such a row falls
through to the next rule and in the end to the default.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from ledgerloom.config import CarrierRule, SourceRule


def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def any_of(column: str, values: Iterable[str]) -> str:
    return f"{column} IN ({', '.join(literal(v) for v in values)})"


def starts(column: str, prefix: str) -> str:
    return f"startswith({column}, {literal(prefix)})"


def tail(column: str, start: int) -> str:
    """The text from the 1-based position ``start`` to its end."""
    return column if start == 1 else f"substring({column}, {start})"


def first_match(branches: Iterable[tuple[str, str]], default: str) -> str:
    cases = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {cases} ELSE {default} END" if cases else default


def code_map(column: str, mapping: dict[str, str], default: str) -> str:
    """Mapped value of a code.  A map keeps the generated code short for long lists."""
    entries = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in mapping.items())
    return f"coalesce(map({entries})[{column}], {default})"


def _condition(rule: SourceRule, company: str, day: str) -> str:
    tests = [any_of(company, rule.companies)]
    if rule.since is not None:
        tests.append(f"{day} >= DATE '{rule.since}'")
    if rule.until is not None:
        tests.append(f"{day} <= DATE '{rule.until}'")
    if rule.on is not None:
        tests.append(f"{day} = DATE '{rule.on}'")
    if rule.prefix is not None:
        tests.append(starts(rule.source, rule.prefix))
    return " AND ".join(tests)


def by_source(
    rules: tuple[SourceRule, ...], company: str, default: str, day: str = "docdate"
) -> str:
    """The column that the first fitting rule names."""
    return first_match(
        ((_condition(rule, company, day), tail(rule.source, rule.start)) for rule in rules), default
    )


def carrier_index(rules: tuple[CarrierRule, ...], company: str) -> str:
    """Position of the rule a company belongs to, NULL for none."""
    members = [(c, i) for i, rule in enumerate(rules) for c in rule.companies]
    if len({c for c, _ in members}) < len(members):
        raise ValueError("a company occurs in more than one carrier rule")
    return f"map({', '.join(f'{literal(c)}, {i}' for c, i in members)})[{company}]"


def per_carrier(
    rules: tuple[CarrierRule, ...], index: str, value: Callable[[CarrierRule], str]
) -> str:
    cases = " ".join(f"WHEN {i} THEN {value(rule)}" for i, rule in enumerate(rules))
    return f"CASE {index} {cases} END"
