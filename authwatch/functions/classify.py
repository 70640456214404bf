"""Classification and extraction expressions over the message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (text to look for, label), first hit wins.
LEVEL_RULES = [("failed", "ERROR"), ("invalid", "WARN")]
LEVEL_DEFAULT = "INFO"

ERROR_RULES = [
    ("failed password", "login failed"),
    ("invalid user", "invalid user"),
    ("accepted password", "login success"),
    ("connection closed", "connection closed"),
]
ERROR_DEFAULT = "etc"

PATTERN_RULES = [
    ("Failed password", "Failed password"),
    ("Accepted password", "Accepted password"),
    ("Invalid user", "Invalid user"),
    ("Connection closed", "Connection closed"),
    ("session opened", "Session opened"),
    ("session closed", "Session closed"),
]
PATTERN_DEFAULT = "Other"

# The error types that count as a failed login.
FAILURE_TYPES = ("login failed", "invalid user")

# Extraction patterns, and the form of a dotted quad.
USER_PATTERN = r"user ([^ ]+)"
IP_PATTERN = r"from ([0-9.]+)"
PORT_PATTERN = r"port ([0-9]+)"
IPV4_PATTERN = (r"^(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
                r"(\.(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")


def first_match(text: Column, rules, default: str) -> Column:
    """Label of the first rule whose literal occurs in ``text``."""
    (needle, label), *rest = rules
    chain = F.when(F.contains(text, F.lit(needle)), F.lit(label))
    for needle, label in rest:
        chain = chain.when(F.contains(text, F.lit(needle)), F.lit(label))
    return chain.otherwise(F.lit(default))


def level(lower_message: Column) -> Column:
    return first_match(lower_message, LEVEL_RULES, LEVEL_DEFAULT)


def error_type(lower_message: Column) -> Column:
    return first_match(lower_message, ERROR_RULES, ERROR_DEFAULT)


def message_pattern(message: Column) -> Column:
    """Case-sensitive report label; a missing message counts as Other."""
    return first_match(message, PATTERN_RULES, PATTERN_DEFAULT)


def has_text(message: Column, literal: str) -> Column:
    """Case-sensitive literal search, false for a missing message."""
    return F.coalesce(F.contains(message, F.lit(literal)), F.lit(False))


def user(message: Column) -> Column:
    """Empty text, not NULL, when the line names no user."""
    return F.regexp_extract(message, USER_PATTERN, 1)


def ip(message: Column) -> Column:
    return F.nullif(F.regexp_extract(message, IP_PATTERN, 1), F.lit(""))


def port(message: Column) -> Column:
    """NULL when absent or too large for an integer."""
    return F.nullif(F.regexp_extract(message, PORT_PATTERN, 1), F.lit("")).try_cast("int")


def valid_ipv4(value: Column) -> Column:
    return F.when(value.rlike(IPV4_PATTERN), value)


def is_failure(types=FAILURE_TYPES) -> Column:
    """Failed login with a known source address."""
    return F.col("error_type").isin(*types) & F.col("ip").isNotNull()
