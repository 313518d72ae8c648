"""Borrower features from transactional text messages, as Spark DataFrame operators."""

from .rules import DEFAULT_RULES, Label, RuleSet

__all__ = ["DEFAULT_RULES", "Label", "RuleSet"]
