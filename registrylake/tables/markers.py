"""Numbered markers: what a folder of data holds, changed in one step."""

from __future__ import annotations

import json

from registrylake.sources.files import Files

#: How many of the last markers are kept.
_KEPT = 8


def folder_name(number: int, identity: str) -> str:
    """Name of a data folder that is written by someone who saw marker ``number`` last."""
    return f"v{number:012d}-{identity}"


def older(folder: str, other: str) -> bool:
    """Whether the writer of a data folder started from an older marker than that of another."""
    return folder < other.partition("-")[0]


class Markers:
    """Files ``<number>.json`` in a folder; each holds the whole state, the last valid one counts.

    A marker is created only if its number is not taken, and appears whole. So writers that
    start from one state notice each other, and a stop at any time leaves one state or the next.
    """

    def __init__(self, files: Files, folder: str):
        self.files, self.folder = files, folder

    def last(self) -> tuple[int, dict]:
        """Number of the last marker, and the tables of the last valid one."""
        names = sorted(self.files.names(self.folder, "*.json"), reverse=True)
        last = int(names[0].removesuffix(".json")) if names else 0
        for name in names:
            try:
                return last, json.loads(self.files.read_text(f"{self.folder}/{name}") or "")["tables"]
            except (ValueError, KeyError, TypeError):
                continue  # cut short by a store that cannot rename
        return last, {}

    def publish(self, number: int, tables: dict) -> bool:
        """Make the tables the state with this number; False if it is taken."""
        return self.files.create_new(f"{self.folder}/{number:012d}.json", json.dumps({"tables": tables}))

    def clean(self, number: int) -> None:
        for name in self.files.names(self.folder, "*.json"):
            if int(name.removesuffix(".json")) <= number - _KEPT:
                self.files.delete(f"{self.folder}/{name}")
