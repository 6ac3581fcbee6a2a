"""Exact deduplication by a tree-merge of sorted digest runs.

Every partition turns its rows into one sorted run of (digest, identifier, count), a row for each distinct digest.
Runs then meet in binomial rounds: the slots that differ only in digit j of their number exchange the parts of their
runs that belong to digit j of the digest, and each merges what it receives into one sorted run again. After as many
rounds as a slot number has digits, a slot holds one range of the digests, merged over all partitions. A run keeps
its size over the rounds, no task sees more than FANIN times a run, and a digest that a third of all rows share is
one entry of each run from the start.

Defined results: a null text counts as empty, so null and empty texts form one group. A null identifier takes part
but never wins against another; a group of null identifiers alone has a null keep_id and keeps its rows. Rows that
share identifier and text are one row repeated: they count towards group_size and stay or go together. An empty table
gives an empty result. Further columns, also ones named as the results, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, skew_join, written

#: Slots that exchange runs in one round; a power of two, so that a digit is a group of bits.
FANIN = 8
#: Rows of a slot at the end, at most, on average.
SLOT_ROWS = 250_000

_BITS = FANIN.bit_length() - 1
_RUN = "slot long, run binary"
#: A run's entry: the digest as four words in order, a second fingerprint (length and 64-bit hash) that verifies it, identifier and count.
_ENTRY = np.dtype([("d0", "<u8"), ("d1", "<u8"), ("d2", "<u8"), ("d3", "<u8"), ("size", "<i8"), ("mark", "<i8"), ("id", "<i8"), ("n", "<i8")])
_KEY = ("d0", "d1", "d2", "d3", "size", "mark")
_MERGED = "digest binary, size long, mark long, keep_id long, group_size long"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier, SHA-256 of the normalised text, and a second fingerprint of length and hash."""
    norm = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm")).select(
        "doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").cast("long").alias("size"), F.xxhash64("norm").alias("mark")
    )


def sorted_run(entries: np.ndarray, keep: str) -> np.ndarray:
    """Entries in any order as a run: sorted, with one entry for each verified digest."""
    return _one_each(entries[np.lexsort([entries[k] for k in reversed(_KEY)])], keep)


def merge_runs(runs: list[np.ndarray], keep: str) -> np.ndarray:
    """Several runs as one, merged FANIN at a time; each merge keeps one entry for each verified digest."""
    runs = [r for r in runs if len(r)]
    while len(runs) > 1:
        runs = [_one_each(_merged(runs[k : k + FANIN]), keep) for k in range(0, len(runs), FANIN)]
    return runs[0] if runs else np.zeros(0, _ENTRY)


def _merged(runs: list[np.ndarray]) -> np.ndarray:
    """All entries of some runs in order: an entry's place is that in its own run and those that it takes in the others."""
    heads = [np.ascontiguousarray(r["d0"]) for r in runs]
    out = np.empty(sum(map(len, runs)), _ENTRY)
    for i, (run, head) in enumerate(zip(runs, heads, strict=True)):
        place = np.arange(len(run))
        for j, other in enumerate(heads):
            if j != i:
                place += np.searchsorted(other, head, "right" if j < i else "left")
        out[place] = run
    # digests that agree in the first word alone: rare, and put in full order here
    same = out["d0"][1:] == out["d0"][:-1]
    if (same & _changes(out)).any():
        tied = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
        out[tied] = out[tied][np.lexsort([out[k][tied] for k in reversed(_KEY)])]
    return out


def _changes(entries: np.ndarray) -> np.ndarray:
    """Where an entry's digest, length or hash differs from that of the one before it."""
    found = np.zeros(max(0, len(entries) - 1), bool)
    for k in _KEY:
        found |= entries[k][1:] != entries[k][:-1]
    return found


def _one_each(entries: np.ndarray, keep: str) -> np.ndarray:
    """Sorted entries, with one for each verified digest: the identifier that stays, and the count."""
    if len(entries) < 2:
        return entries
    # The same digest with another length or hash would be a collision: such entries stay apart.
    starts = np.flatnonzero(np.insert(_changes(entries), 0, True))
    out = entries[starts]
    best = np.minimum if keep == "smallest" else np.maximum
    out["id"] = best.reduceat(entries["id"], starts)
    out["n"] = np.add.reduceat(entries["n"], starts)
    return out


def _dealt(run: np.ndarray, slot: int, digit: int, digits: int):
    """The parts of a sorted run by digit `digit` of the digest, each with the slot that gets it."""
    shift = _BITS * (digits - 1 - digit)
    if not len(run):
        return
    value = (run["d0"] >> np.uint64(64 - _BITS * (digit + 1))) & np.uint64(FANIN - 1)
    base = slot & ~((FANIN - 1) << shift)
    cuts = np.flatnonzero(np.diff(value)) + 1  # sorted: all earlier digits of the digest are equal in a slot's run
    for part in np.split(np.arange(len(run)), cuts):
        yield base | int(value[part[0]]) << shift, run[part[0] : part[-1] + 1].tobytes()


def _table(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"slot": pa.array([r[0] for r in rows], pa.int64()), "run": pa.array([r[1] for r in rows], pa.binary())})


def keep_one(found: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per distinct digest of `found` (as digests() gives it): who stays, and the group's size."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    spark = found.sparkSession
    loses = np.iinfo(np.int64).max if keep == "smallest" else np.iinfo(np.int64).min
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), found.count() // SLOT_ROWS, 2)
    digits = 1
    while FANIN**digits < least:
        digits += 1
    slots = FANIN**digits

    def first(batches):
        runs, slot = [], TaskContext.get().partitionId() % slots
        for batch in batches:
            entry = np.zeros(batch.num_rows, _ENTRY)
            words = np.frombuffer(b"".join(batch["digest"].to_pylist()), ">u8").reshape(-1, 4)
            for k in range(4):
                entry[f"d{k}"] = words[:, k]
            for k in ("size", "mark"):
                entry[k] = batch[k].to_numpy(zero_copy_only=False)
            entry["id"] = batch["doc_id"].fill_null(loses).to_numpy(zero_copy_only=False)
            entry["n"] = 1
            runs.append(sorted_run(entry, keep))
        if runs:
            run = merge_runs(runs, keep)
            # digit 0 is the most significant one, so the parts are contiguous in the sorted run
            yield from _table(list(_dealt(run, slot, 0, digits))).to_batches()

    def merged(table: pa.Table) -> tuple[int, np.ndarray]:
        return table["slot"][0].as_py(), merge_runs([np.frombuffer(x, _ENTRY) for x in table["run"].to_pylist()], keep)

    def exchange(digit: int):
        def step(table: pa.Table) -> pa.Table:
            slot, run = merged(table)
            return _table(list(_dealt(run, slot, digit, digits)))

        return step

    def last(table: pa.Table) -> pa.Table:
        run = merged(table)[1]
        packed = np.empty((len(run), 4), ">u8")
        for k in range(4):
            packed[:, k] = run[f"d{k}"]
        flat = packed.tobytes()
        return pa.table(
            {
                "digest": pa.array([flat[i : i + 32] for i in range(0, len(flat), 32)], pa.binary()),
                "size": pa.array(run["size"].astype(np.int64)),
                "mark": pa.array(run["mark"].astype(np.int64)),
                "keep_id": pa.array(run["id"].astype(np.int64), mask=run["id"] == loses),
                "group_size": pa.array(run["n"].astype(np.int64)),
            }
        )

    runs = found.mapInArrow(first, _RUN)
    for digit in range(1, digits):
        runs = runs.groupBy("slot").applyInArrow(exchange(digit), _RUN)
    return runs.groupBy("slot").applyInArrow(last, _MERGED)


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs with the identifier that stays of its group: doc_id, keep_id, group_size, kept, digest."""
    found = written(digests(docs, id_col, text_col), "digests")
    groups = written(keep_one(found, keep), "digest-groups")
    joined = skew_join(found, groups, ["digest", "size", "mark"], "group_size", found.count())
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
