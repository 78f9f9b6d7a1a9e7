"""Idempotent loads of the normalised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemerge.operators.merge import merge_insert_only, total_order
from tidemerge.types import CONTACT_KEYS, MESSAGE_KEYS, STATUS_KEYS

KEYS = {"messages": MESSAGE_KEYS, "statuses": STATUS_KEYS, "contacts": CONTACT_KEYS}
TIME = {"messages": "message_timestamp", "statuses": "status_timestamp", "contacts": "turn_updated_at"}


def arrival_order(rows: DataFrame, entity: str) -> list[str]:
    return total_order(rows, [TIME[entity]], KEYS[entity])


def load(target: DataFrame, rows: DataFrame, entity: str) -> DataFrame:
    return merge_insert_only(target, rows, KEYS[entity], arrival_order(rows, entity))


def load_messages(target: DataFrame, rows: DataFrame) -> DataFrame:
    return load(target, rows, "messages")


def load_statuses(target: DataFrame, rows: DataFrame) -> DataFrame:
    return load(target, rows, "statuses")


def load_contacts(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Keeps every distinct snapshot of a contact, not just the newest."""
    return load(target, rows, "contacts")
