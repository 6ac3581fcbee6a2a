"""A versioned store of the engine's tables on files.

A write makes new directories for what it adds and then moves one pointer, a small file that names the directories of
every table: what belongs together becomes visible together, and a failed write leaves nothing behind that is read.

An append adds one directory (a part) and reads nothing. Parts have levels: as soon as FOLD parts of a level follow
each other at the end, they are written as one of the next level, so that a row is written again once per level, and a
table of n parts has some log n of them. For candles the pointer names parts per series. Candles that are all later
than their series are appended; an upsert that meets older ones rewrites the series that it touches, and no others. A
lookup reads one series.

The folder's file system must refuse to rename to a name that exists (HDFS and local disks do); an object store
without that needs a single writer.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.errors import StoreError, StoreInitError, StoreIntegrityError
from tidemark.types import KEYS, PRICES, SCHEMA_VERSION, TABLES, VOLUMES, epoch_ms, interval_ms, symbol_name

#: Parts of a level that are written as one of the next.
FOLD = 16

PARENTS = {
    "klines": [("symbol", "symbols", "symbol"), ("raw_response_id", "raw_api_responses", "id")],
    "symbol_status_events": [("symbol", "symbols", "symbol"), ("raw_response_id", "raw_api_responses", "id")],
    "ticker_snapshots": [("symbol", "symbols", "symbol"), ("raw_response_id", "raw_api_responses", "id")],
    "raw_api_responses": [("ingestion_run_id", "ingestion_runs", "id")],
}


# -- frames ----------------------------------------------------------------------------------------------------------


def latest_rows(df: DataFrame, keys: Sequence[str], by: str, n: int) -> DataFrame:
    """The n rows of each group with the largest `by`."""
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise ValueError(f"a limit is a positive whole number, got {n!r}")
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(by)))).filter(F.col("_rank") <= n).drop("_rank")


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Rows of both with one row per key: that of `new` with the largest position, else that of `old`.

    A maximum per key, taken on both sides before the shuffle, in place of a sort of every group.
    """
    columns = [c for c in new.columns if c != position]
    value = F.struct(*columns)
    rows = old.select(*columns).select(*keys, F.struct(F.lit(0).alias("new"), F.lit(0).cast("long").alias("at")).alias("order"), value.alias("row"))
    rows = rows.unionByName(new.select(*keys, F.struct(F.lit(1).alias("new"), F.col(position).cast("long").alias("at")).alias("order"), value.alias("row")))
    return rows.groupBy(*keys).agg(F.max_by("row", "order").alias("row")).select("row.*")


def orphans(children: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Children whose reference isn't NULL and has no parent."""
    return children.filter(F.col(column).isNotNull()).join(parents.select(F.col(key).alias(column)).distinct(), column, "left_anti")


# -- scalars ---------------------------------------------------------------------------------------------------------


def decimal_text(value: Any, name: str = "value") -> Decimal:
    """A finite exact number from text, a whole number or a Decimal; floats and booleans aren't exact."""
    if isinstance(value, bool | float):
        raise TypeError(f"{name} must be exact, got {type(value).__name__}")
    try:
        found = Decimal(str(value))
    except InvalidOperation as e:
        raise ValueError(f"{name} is no number: {value!r}") from e
    if not found.is_finite():
        raise ValueError(f"{name} must be finite, got {value!r}")
    return found


def kline_row(row: dict, index: int = 0) -> dict:
    """A candle's values checked and typed."""
    try:
        out = {"symbol": symbol_name(row["symbol"]), "interval": row["interval"], "number_of_trades": int(row["number_of_trades"]), "raw_response_id": row.get("raw_response_id")}
        interval_ms(out["interval"])
        out |= {c: epoch_ms(row[c], c) for c in ("open_time", "close_time")}
        out |= {c: decimal_text(row[c], c) for c in (*PRICES, *VOLUMES)}
    except KeyError as e:
        raise ValueError(f"row {index} has no {e}") from e
    except (TypeError, ValueError) as e:
        raise type(e)(f"row {index}: {e}") from e
    return out


class Store:
    """Tables in versions under one folder (see the module)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # versions

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *names]))

    def _pointer(self) -> dict | None:
        """The newest complete pointer."""
        if not self._fs.exists(self._path("versions")):
            return None
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path("versions")) if s.getPath().getName().endswith(".json"))
        if not names:
            return None
        return json.loads("\n".join(r[0] for r in self.spark.read.text(f"{self.folder}/versions/{names[-1]}").collect()))

    def _commit(self, pointer: dict) -> None:
        """Writes the next pointer under a name of its own and renames it; of two writers of one number one fails."""
        name = f"{pointer['number']:012d}.json"
        draft = self._path("versions", f"_{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        if self._fs.exists(self._path("versions", name)) or not self._fs.rename(draft, self._path("versions", name)):
            raise StoreError(f"version {pointer['number']} has been written by another")

    def initialize(self) -> None:
        """Makes the store, or checks that this version can read it; can be repeated."""
        pointer = self._pointer()
        if pointer is None:
            self._commit({"number": 0, "schema_version": SCHEMA_VERSION, "tables": {}})
        elif pointer["schema_version"] > SCHEMA_VERSION:
            raise StoreInitError(f"the store has schema {pointer['schema_version']}; {SCHEMA_VERSION} is known")

    def schema_version(self) -> int | None:
        pointer = self._pointer()
        return pointer and pointer["schema_version"]

    def _tables(self) -> dict:
        return (self._pointer() or {"tables": {}})["tables"]

    def table(self, name: str) -> DataFrame:
        """The current version of a table."""
        if name not in TABLES:
            raise StoreError(f"no table {name}")
        at = self._tables().get(name, [])
        return self._read(name, [part for series in at.values() for part in series["parts"]] if isinstance(at, dict) else at)

    def _read(self, name: str, parts: Sequence[Sequence]) -> DataFrame:
        """Rows of some parts, which are pairs of a path and a level."""
        if not parts:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*(f"{self.folder}/{path}" for path, _ in parts))

    def _series(self, pairs: Sequence[tuple[str, str]]) -> DataFrame:
        """Candles of some series (interval, symbol)."""
        at = self._tables().get("klines", {})
        return self._read("klines", [part for k in (f"{i}/{s}" for i, s in pairs) for part in at.get(k, {"parts": []})["parts"]])

    def _saved(self, name: str, df: DataFrame, number: int) -> str:
        path = f"data/{name}/{number:012d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{path}")
        return path

    def _folded(self, name: str, parts: list, number: int) -> list:
        """Parts, with FOLD of one level at the end written as one."""
        while len(parts) >= FOLD and len({level for _, level in parts[-FOLD:]}) == 1:
            whole = self._saved(name, self._read(name, parts[-FOLD:]), number)
            parts = [*parts[:-FOLD], [whole, parts[-1][1] + 1]]
        return parts

    def _write(self, frames: dict[str, DataFrame], added: dict[str, DataFrame] | None = None, last_ids: dict[str, int] | None = None, later: bool = False) -> None:
        """Tables that frames replace and rows that are added, visible together; of candles, the series in a frame (added to if later)."""
        pointer = self._pointer()
        if pointer is None:
            raise StoreError("the store isn't initialized")
        tables, number = dict(pointer["tables"]), pointer["number"] + 1
        for name, df in frames.items():
            tables[name] = self._with_series(tables.get(name, {}), df, number, later) if name == "klines" else [[self._saved(name, df, number), 0]]
        for name, df in (added or {}).items():
            tables[name] = self._folded(name, [*tables.get(name, []), [self._saved(name, df, number), 0]], number)
        self._commit(pointer | {"number": number, "tables": tables, "last_ids": pointer.get("last_ids", {}) | (last_ids or {})})

    def _with_series(self, series: dict, df: DataFrame, number: int, later: bool) -> dict:
        """The parts of all series of candles after those in df are written."""
        path = f"data/klines/{number:012d}-{uuid.uuid4().hex}"
        rows = df.withColumns({"p_interval": F.col("interval"), "p_symbol": F.col("symbol")}).sortWithinPartitions("p_interval", "p_symbol", "open_time")
        rows.write.partitionBy("p_interval", "p_symbol").parquet(f"{self.folder}/{path}")
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        written = self.spark.read.parquet(f"{self.folder}/{path}").groupBy("interval", "symbol").agg(F.max("open_time").alias("last")).collect()  # a row per series
        found = dict(series)
        for r in written:
            key, part = f"{r['interval']}/{r['symbol']}", [f"{path}/p_interval={escape(r['interval'])}/p_symbol={escape(r['symbol'])}", 0]
            parts = [*(series.get(key, {"parts": []})["parts"] if later else []), part]
            found[key] = {"parts": self._folded("klines", parts, number), "last": r["last"]}
        return found

    def _frame(self, name: str, rows: Sequence[dict]) -> DataFrame:
        columns = [f.split()[0].strip("`") for f in _fields(TABLES[name])]
        return self.spark.createDataFrame([Row(*(r.get(c) for c in columns)) for r in rows], TABLES[name])

    def _check_parents(self, name: str, df: DataFrame, pending: dict[str, DataFrame] | None = None) -> None:
        for column, parent, key in PARENTS.get(name, []):
            known = (pending or {}).get(parent)
            lost = orphans(df, column, self.table(parent) if known is None else known, key).first()
            if lost:
                raise StoreIntegrityError(f"{name}.{column} {lost[column]!r} is not in {parent}")

    # appends

    def _next_ids(self, name: str, n: int) -> list[int]:
        first = (self._pointer() or {}).get("last_ids", {}).get(name, 0) + 1
        return list(range(first, first + n))

    def _append(self, name: str, rows: Sequence[dict]) -> list[int]:
        """Rows under new identifiers, which the pointer counts: nothing that is stored is read."""
        if not rows:
            return []
        ids = self._next_ids(name, len(rows))
        new = self._frame(name, [r | {"id": i} for r, i in zip(rows, ids, strict=True)])
        self._check_parents(name, new)
        if name == "raw_api_responses":
            new = new.withColumn("content_hash", F.sha2("response_json", 256))
        self._write({}, added={name: new}, last_ids={name: ids[-1]})
        return ids

    def archive_responses(self, rows: Sequence[dict]) -> list[int]:
        """Raw payloads with the SHA-256 of their text; ids in the order given."""
        return self._append("raw_api_responses", [{"fetched_at": epoch_ms(r["fetched_at"]), **r} for r in rows])

    def append_status_events(self, rows: Sequence[dict], verbatim: bool = False) -> list[int]:
        """Status events; statuses are trimmed and in upper case unless verbatim."""
        return self._append("symbol_status_events", [_event(r, verbatim) for r in rows])

    def append_tickers(self, rows: Sequence[dict]) -> list[int]:
        return self._append("ticker_snapshots", [{**r, "symbol": symbol_name(r["symbol"]), "price": decimal_text(r["price"], "price"), "snapshot_at": epoch_ms(r["snapshot_at"])} for r in rows])

    def start_run(self, run_type: str, started_at: int) -> int:
        return self._append("ingestion_runs", [{"run_type": run_type, "started_at": epoch_ms(started_at), "status": "started", "records_fetched": 0, "records_stored": 0}])[0]

    def update_run(self, run_id: int, status: str, **fields: Any) -> None:
        """Sets the status and the fields that aren't None."""
        old = self.table("ingestion_runs")
        if old.filter(F.col("id") == run_id).isEmpty():
            raise StoreError(f"no run {run_id}")
        types = dict(old.dtypes)
        values = {k: F.when(F.col("id") == run_id, F.lit(v).cast(types[k])).otherwise(F.col(k)) for k, v in {"status": status, **fields}.items() if v is not None}
        self._write({"ingestion_runs": old.withColumns(values)})

    # upserts

    def _symbols(self, rows: Sequence[dict]) -> DataFrame:
        defaults = {"is_spot_trading_allowed": False, "is_margin_trading_allowed": False, "base_asset_precision": 8, "quote_asset_precision": 8}
        typed = [defaults | r | {"symbol": symbol_name(r["symbol"]), "updated_at": epoch_ms(r["updated_at"])} for r in rows]
        return self._symbols_merged(self._frame("symbols", typed).withColumn("batch_pos", F.monotonically_increasing_id()))

    def _symbols_merged(self, new: DataFrame) -> DataFrame:
        old = self.table("symbols")
        made = old.select("symbol", F.col("created_at").alias("made_at"))
        found = merged(old, new, KEYS["symbols"], "batch_pos").join(made, "symbol", "left")
        return found.withColumn("created_at", F.coalesce("made_at", F.current_timestamp())).drop("made_at").select(*old.columns)

    def upsert_symbols(self, rows: Sequence[dict]) -> int:
        """Symbols written or replaced; created_at stays."""
        if rows:
            self._write({"symbols": self._symbols(rows)})
        return len(rows)

    def write_universe(self, changes: DataFrame, effective_at: int, raw_response_id: int | None) -> tuple[int, int]:
        """Symbols and status events of universe_diff's changes, visible together: how many of each."""
        changes = changes.cache()
        try:
            n, events = changes.agg(F.count("*"), F.count_if("is_event")).first()
            if n == 0:
                return 0, 0
            new = changes.withColumns({"updated_at": F.lit(effective_at).cast("long"), "created_at": F.lit(None).cast("timestamp"), "batch_pos": F.lit(0)})
            symbols = self._symbols_merged(new.select(*self.table("symbols").columns, "batch_pos"))
            first = self._next_ids("symbol_status_events", 1)[0]
            rows = changes.filter("is_event").select("symbol", "status", "is_spot_trading_allowed", F.lit(effective_at).cast("long").alias("effective_at"), F.lit(raw_response_id).cast("long").alias("raw_response_id"))
            order = F.row_number().over(Window.orderBy("symbol"))  # the instruments of one exchange: thousands
            rows = rows.withColumn("id", (order + first - 1).cast("long"))
            columns = [f.split()[0] for f in _fields(TABLES["symbol_status_events"])]
            self._write({"symbols": symbols}, added={"symbol_status_events": rows.select(*columns)}, last_ids={"symbol_status_events": first + events - 1})
            return n, events
        finally:
            changes.unpersist()

    def upsert_klines(self, rows: Sequence[dict], chunk_size: int = 500) -> int:
        """Candles written or replaced, the last of equal keys; all or none."""
        if not rows:
            return 0
        if isinstance(chunk_size, bool) or not isinstance(chunk_size, int) or chunk_size < 1:
            raise ValueError(f"chunk_size must be positive, got {chunk_size!r}")
        typed = [kline_row(r, i) for i, r in enumerate(rows)]
        last = {tuple(t[k] for k in KEYS["klines"]): t for t in typed}
        return self.upsert_kline_frame(self._frame("klines", list(last.values())).withColumn("batch_pos", F.lit(0)), len(typed))

    def upsert_kline_frame(self, new: DataFrame, count: int | None = None) -> int:
        """Candles of a frame with batch_pos written or replaced."""
        new = new.cache()
        try:
            self._check_parents("klines", new)
            touched = new.groupBy("interval", "symbol").agg(F.min("open_time").alias("first"), F.count("*").alias("n")).collect()  # a row per series
            known = self._tables().get("klines", {})
            after = all(r["first"] > known.get(f"{r['interval']}/{r['symbol']}", {"last": -1})["last"] for r in touched)
            old = self._read("klines", []) if after else self._series([(r["interval"], r["symbol"]) for r in touched])
            columns = [f.split()[0].strip("`") for f in _fields(TABLES["klines"])]
            if touched:
                self._write({"klines": merged(old, new.select(*columns, "batch_pos"), KEYS["klines"], "batch_pos").select(*columns)}, later=after)
            return sum(r["n"] for r in touched) if count is None else count
        finally:
            new.unpersist()

    def insert_kline(self, row: dict) -> None:
        """A candle whose key must be new."""
        typed = kline_row(row)
        new = self._frame("klines", [typed])
        self._check_parents("klines", new)
        old = self._series([(typed["interval"], typed["symbol"])])
        if not old.join(new, KEYS["klines"], "left_semi").isEmpty():
            raise StoreIntegrityError(f"candle {[typed[k] for k in KEYS['klines']]} exists")
        self.upsert_kline_frame(new.withColumn("batch_pos", F.lit(0)))

    # lookups

    def symbol(self, symbol: str) -> Row | None:
        return self.table("symbols").filter(F.col("symbol") == symbol_name(symbol)).first()

    def symbols(self, quote_asset: str | None = None) -> DataFrame:
        found = self.table("symbols")
        if quote_asset is not None:
            found = found.filter(F.col("quote_asset") == symbol_name(quote_asset))
        return found.orderBy("symbol")

    def status_events(self, symbol: str, limit: int = 100) -> DataFrame:
        return self.table("symbol_status_events").filter(F.col("symbol") == symbol_name(symbol)).orderBy(F.desc("effective_at"), F.desc("id")).limit(limit)

    def tickers(self, symbol: str, limit: int = 100) -> DataFrame:
        return self.table("ticker_snapshots").filter(F.col("symbol") == symbol_name(symbol)).orderBy(F.desc("snapshot_at"), F.desc("id")).limit(limit)

    def klines(self, symbol: str, interval: str) -> DataFrame:
        interval_ms(interval)
        return self._series([(interval, symbol_name(symbol))])

    def kline_range(self, symbol: str, interval: str, start: int, end: int) -> DataFrame:
        """Candles from start on and before end."""
        return self.klines(symbol, interval).filter((F.col("open_time") >= epoch_ms(start)) & (F.col("open_time") < epoch_ms(end))).orderBy("open_time")

    def open_times(self, symbol: str, interval: str, start: int, end: int) -> DataFrame:
        """Open times from start to end, both included."""
        return self.klines(symbol, interval).filter(F.col("open_time").between(epoch_ms(start), epoch_ms(end))).select("open_time").orderBy("open_time")

    def latest_klines(self, symbol: str, interval: str, limit: int) -> DataFrame:
        return self.klines(symbol, interval).orderBy(F.desc("open_time")).limit(limit)

    def latest_kline_in_range(self, symbol: str, interval: str, start: int, end: int) -> Row | None:
        return self.klines(symbol, interval).filter(F.col("open_time").between(epoch_ms(start), epoch_ms(end))).orderBy(F.desc("open_time")).first()


def _fields(ddl: str) -> list[str]:
    """Fields of a DDL text, whose types may hold a comma in brackets."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(ddl[at:i].strip())
            at = i + 1
    return [*out, ddl[at:].strip()]


def _event(row: dict, verbatim: bool) -> dict:
    status = row["status"] if verbatim else row["status"].strip().upper()
    if not status:
        raise ValueError("a status is a non-empty string")
    return {**row, "symbol": symbol_name(row["symbol"]), "status": status, "effective_at": epoch_ms(row["effective_at"])}


def now_ms() -> int:
    return int(time.time() * 1000)


__all__ = ["Store", "latest_rows", "merged", "orphans", "decimal_text", "kline_row", "now_ms"]
