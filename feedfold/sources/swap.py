"""Exchanging files of a table so that a lost driver leaves it old or new, never a mix for good.

New files are first written whole under the table's ``_swap`` folder, which readers pass over. Only then does a small
record say which old paths go and which staged ones take their places, and the exchange is carried out from that record. A driver
lost before the record leaves the table as it was, and the next writer clears the staged files away; one lost after it leaves an
exchange that the next writer, or ``settle``, completes. Every step can be repeated.

The record is also the table's lock: it is created by a write that fails where one exists, so of two writers one is refused. A
writer that is gone for good loses the lock when its lease runs out, or when a run of the same name comes again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from feedfold.sources.files import Store

SWAP = "_swap"
LEASE_SECONDS = 6 * 3600


class TableBusy(RuntimeError):
    """Another writer holds the table."""


@dataclass
class Exchange:
    """What a writer has staged: paths to remove, and (staged, place) pairs to move. A place that exists makes way for what is moved there."""

    removes: list[str] = field(default_factory=list)
    moves: list[tuple[str, str]] = field(default_factory=list)


def _record(table: str) -> str:
    return f"{table}/{SWAP}/intent"


def _carry_out(store: Store, intent: dict) -> None:
    """Old paths go, staged ones take their places. What an earlier attempt has done is passed over."""
    for staged, place in intent["moves"]:
        if store.exists(staged):
            store.remove(place)
            store.move(staged, place)
    for path in intent["removes"]:
        store.remove(path)


def _clear(store: Store, table: str, intent: dict) -> None:
    store.remove(intent["staged"])
    store.remove(_record(table))
    store.remove(f"{_record(table)}.new")


def settle(spark: SparkSession, table: str, owner: str | None = None, now: float | None = None) -> str | None:
    """Finish or undo what a lost writer left; says which ("completed", "undone") or None where there was nothing.

    A record whose lease still runs is left alone, and TableBusy raised, unless it is the given owner's: the run of that name has come again.
    """
    store = Store(spark, table)
    intent = store.read(_record(table))
    if intent is None:
        if store.exists(_record(table)) or store.exists(f"{_record(table)}.new"):  # broken off while it was made: nothing was exchanged
            store.remove(_record(table))
            store.remove(f"{_record(table)}.new")
        return None
    if intent["owner"] != owner and (time.time() if now is None else now) < intent["until"]:
        raise TableBusy(f"{table} is being written by {intent['owner']!r}; its lease runs until {intent['until']:.0f}")
    if intent["ready"]:
        _carry_out(store, intent)
    _clear(store, table, intent)
    return "completed" if intent["ready"] else "undone"


def swap(spark: SparkSession, table: str, write: Callable[[str], Exchange], owner: str | None = None, lease: float = LEASE_SECONDS) -> None:
    """Let ``write`` fill a staging folder and name the exchange, then carry it out.

    A writer that fails lets go of the table, which stays as it was. ``owner`` names a run that can come again after its driver was lost.
    """
    settle(spark, table, owner)
    store, tag = Store(spark, table), uuid.uuid4().hex[:12]
    intent = {"owner": owner or tag, "until": time.time() + lease, "staged": f"{table}/{SWAP}/{tag}", "ready": False, "moves": [], "removes": []}
    if not store.write_new(_record(table), intent):
        raise TableBusy(f"{table} has another writer")
    try:
        exchange = write(intent["staged"])
    except BaseException:
        _clear(store, table, intent)
        raise
    held = store.read(_record(table))
    if held is None or held["staged"] != intent["staged"]:  # the lease ran out and another writer took over
        store.remove(intent["staged"])
        raise TableBusy(f"{table} was taken over by another writer")
    intent |= {"ready": True, "moves": exchange.moves, "removes": exchange.removes}
    store.replace(_record(table), intent)
    _carry_out(store, intent)
    _clear(store, table, intent)


def leaf_folders(store: Store, root: str, columns: Sequence[str]) -> list[str]:
    """Paths below a root, relative to it, of the folders of all partition columns."""
    found = [""]
    for column in columns:
        found = [f"{at}/{n}" for at in found for n in store.names(f"{root}{at}") if n.startswith(f"{column}=")]
    return [f[1:] for f in found]
