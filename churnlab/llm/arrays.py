"""Sorted tables in the shared folder that workers map into memory: neither the
driver nor a broadcast holds them."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from churnlab.llm.common import mounted, shared_folder

#: Rows of a stored array.
STORED_ROWS = 2_000_000
_NAMES = pa.schema([("first", pa.int64()), ("name", pa.string())])


def _stored(batches, folder: str):
    """A partition's sorted rows (key, value) as two arrays; the name is new for every
    attempt of a task, and only the names handed on are read."""
    parts = [b for b in batches if b.num_rows]
    if parts:
        name = uuid.uuid4().hex
        os.makedirs(mounted(folder), exist_ok=True)
        columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts]) for i in (0, 1)]
        for column, values in zip(("keys", "values"), columns):
            np.save(os.path.join(mounted(folder), f"{name}-{column}.npy"), values)
        yield pa.RecordBatch.from_pydict({"first": [int(columns[0][0])], "name": [name]}, schema=_NAMES)


@dataclass
class SortedArrays:
    """Arrays of (key, value) in the order of the keys."""

    folder: str
    firsts: list[int]
    names: list[str]

    def __post_init__(self):
        self.opened: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return self.folder, self.firsts, self.names

    def __setstate__(self, state):
        self.folder, self.firsts, self.names = state
        self.opened = {}

    def _part(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if name not in self.opened:
            self.opened[name] = tuple(np.load(os.path.join(mounted(self.folder), f"{name}-{c}.npy"), mmap_mode="r") for c in ("keys", "values"))
        return self.opened[name]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each of the sorted keys (0 if there is none), and whether there is one."""
        values, has = np.zeros(len(keys)), np.zeros(len(keys), bool)
        cuts = np.append(np.searchsorted(keys, np.array(self.firsts, np.int64)), len(keys))
        for name, low, high in zip(self.names, cuts, cuts[1:]):
            if low < high:
                own, stored = self._part(name)
                at = np.minimum(np.searchsorted(own, keys[low:high]), len(own) - 1)
                has[low:high] = own[at] == keys[low:high]
                values[low:high] = np.where(has[low:high], stored[at], 0.0)
        return values, has


def sorted_arrays(table: DataFrame, rows: int = STORED_ROWS) -> SortedArrays:
    """Store rows (key long, value double), keys not null and different, as sorted
    arrays of about ``rows`` rows; one short row of each comes to the driver."""
    folder = shared_folder(table.sparkSession, "arrays")
    key = table.columns[0]
    parts = max(1, -(-table.count() // rows))
    ranged = table.repartitionByRange(parts, key).sortWithinPartitions(key)
    found = sorted((r["first"], r["name"]) for r in ranged.mapInArrow(lambda batches: _stored(batches, folder), "first long, name string").collect())
    return SortedArrays(folder, [f for f, _ in found], [n for _, n in found])


def small(values: np.ndarray) -> np.ndarray:
    """Whole numbers of at least 0 in as few bytes as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def store(folder: str, **arrays: np.ndarray) -> str:
    """Store arrays under a new name."""
    name = uuid.uuid4().hex
    os.makedirs(mounted(folder), exist_ok=True)
    for column, array in arrays.items():
        np.save(os.path.join(mounted(folder), f"{name}-{column}.npy"), array)
    return name


def stored(folder: str, name: str, column: str) -> np.ndarray:
    """An array under a name, mapped into memory."""
    return np.load(os.path.join(mounted(folder), f"{name}-{column}.npy"), mmap_mode="r")


def store_coded(folder: str, keys: np.ndarray, codes: np.ndarray, values: np.ndarray) -> str:
    """Store sorted keys with rows of ``values`` (each row once, told by its code) under
    a new name: for ``CodedArrays``. The 255 most frequent rows take a byte a key; the
    keys of others are listed apart."""
    often = np.argsort(-np.bincount(codes, minlength=len(values)), kind="stable")
    place = np.empty_like(often)
    place[often] = np.arange(len(often))
    codes = place[codes]
    others = np.flatnonzero(codes >= 255)
    return store(folder, keys=keys, codes=np.minimum(codes, 255).astype(np.uint8), others=small(others), their=small(codes[others]), values=values[often].astype(float))


@dataclass
class CodedArrays:
    """Arrays of keys in their order, each with a row of ``width`` values."""

    folder: str
    parts: list[tuple[int, str]]
    width: int

    def __post_init__(self):
        self.parts = sorted(self.parts)
        self.opened: dict[str, list[np.ndarray]] = {}

    def __getstate__(self):
        return self.folder, self.parts, self.width

    def __setstate__(self, state):
        self.folder, self.parts, self.width = state
        self.opened = {}

    def _part(self, name: str) -> list[np.ndarray]:
        if name not in self.opened:
            self.opened[name] = [stored(self.folder, name, c) for c in ("keys", "codes", "others", "their", "values")]
        return self.opened[name]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of each of the sorted keys (0 if there are none) as rows, and whether there are."""
        values, has = np.zeros((len(keys), self.width)), np.zeros(len(keys), bool)
        cuts = np.append(np.searchsorted(keys, np.array([first for first, _ in self.parts], np.int64)), len(keys))
        for (_, name), low, high in zip(self.parts, cuts, cuts[1:]):
            if low < high:
                own, codes, others, their, rows = self._part(name)
                at = np.minimum(np.searchsorted(own, keys[low:high]), len(own) - 1)
                hit = np.flatnonzero(own[at] == keys[low:high])
                has[low + hit] = True
                code = codes[at[hit]].astype(np.int64)
                rare = np.flatnonzero(code == 255)
                if len(rare):
                    code[rare] = their[np.searchsorted(others, at[hit[rare]])]
                values[low + hit] = rows[code]
        return values, has
