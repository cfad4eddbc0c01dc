"""Delimited records split into rows that can land and rows to quarantine, with the reason.

Blocks of records are parsed in bulk by a columnar CSV reader and checked by columnar masks. A block that the reader refuses is halved until the
records it can't read stand alone; only bad records are read by the strict parser, which says what is wrong."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame

from tidewright.session import ship, spread

BLOCK = 4096
BLANKS = " \t\r\n"
NULLS = pa.array(["", "NULL", "null"])
#: A record: fields free of quotes, or quoted whole with inner quotes doubled.
WELL_QUOTED = r'\A(?s:[^",]*|"(?:[^"]|"")*")(?:,(?s:[^",]*|"(?:[^"]|"")*"))*\z'
TIMESTAMP = r"\A(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-4]):[0-5]\d)?\z"


@dataclass(frozen=True)
class Column:
    """What a field must be, once blanks around it are removed and '', NULL and null are read as null."""

    name: str
    required: bool = False
    values: tuple[str, ...] = ()  # any of these; null fits only if not given
    pattern: str = ""  # for values that aren't null
    timestamp: bool = False


def split_fields(record: str) -> list[str] | None:
    """The strict reading: the fields' values; None if quotes don't stand as they must."""
    out, i, n = [], 0, len(record)
    while True:
        if i < n and record[i] == '"':
            parts, i = [], i + 1
            while True:
                j = record.find('"', i)
                if j < 0:
                    return None
                parts.append(record[i:j])
                if j + 1 < n and record[j + 1] == '"':
                    parts.append('"')
                    i = j + 2
                    continue
                i = j + 1
                break
            if i < n and record[i] != ",":
                return None
            out.append("".join(parts))
        else:
            j = record.find(",", i)
            j = n if j < 0 else j
            if '"' in record[i:j]:
                return None
            out.append(record[i:j])
            i = j
        if i >= n:
            return out
        i += 1  # past the comma; a comma at the end leaves an empty last field
        if i == n:
            return [*out, ""]


def nulled(value: str) -> str | None:
    value = value.strip(BLANKS)
    return None if value in ("", "NULL", "null") else value


def fits(column: Column, value: str | None) -> bool:
    if value is None:
        return not column.required and not column.values
    if column.values and value not in column.values:
        return False
    if column.pattern and not re.fullmatch(column.pattern, value, re.ASCII):
        return False
    if column.timestamp:
        m = re.match(TIMESTAMP.replace(r"\z", r"\Z"), value, re.ASCII)
        try:
            return m is not None and m[2] < "24" and bool(datetime.fromisoformat(f"{m[1]}T{m[2]}"))
        except ValueError:
            return False
    return True


def diagnose(record: str | None, columns: tuple[Column, ...]) -> tuple[str | None, str | None, list | None]:
    """Reason, detail and values of one record; the reason is null if it can land. A null record has no fields."""
    if record is None:
        return "COLUMN_COUNT", "no record", None
    fields = split_fields(record)
    if fields is None:
        return "QUOTING", "quotes", None
    if len(fields) != len(columns):
        return "COLUMN_COUNT", f"{len(fields)} of {len(columns)} fields", None
    values = [nulled(f) for f in fields]
    wrong = [c.name for c, v in zip(columns, values) if not fits(c, v)]
    return ("INVALID_VALUE", ", ".join(wrong), None) if wrong else (None, None, values)


def _sorted_out(records: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the records with `width` fields that have no quotes, of those whose quotes stand as they must, and of all others."""
    mask = lambda x: pc.fill_null(x, False).to_numpy(zero_copy_only=False)
    quoted = mask(pc.match_substring(records, '"'))
    plain = ~quoted & mask(pc.equal(pc.count_substring(records, ","), width - 1))
    at = well = np.flatnonzero(quoted)
    if len(at):
        some = records.take(pa.array(at))
        bare = pc.replace_substring_regex(some, r'"(?:[^"]|"")*"', "")  # where quotes stand right, the commas that are left separate fields
        well = at[mask(pc.match_substring_regex(some, WELL_QUOTED)) & mask(pc.equal(pc.count_substring(bare, ","), width - 1))]
    apart = ~plain
    apart[well] = False
    return np.flatnonzero(plain), well, np.flatnonzero(apart)


def _split(records: pa.Array, width: int) -> list[pa.Array]:
    """The fields, by column, of records without quotes."""
    flat = pc.split_pattern(records, ",").flatten()
    return [flat.take(pa.array(np.arange(k, len(flat), width))) for k in range(width)]


def _parsed(records: pa.Array, width: int) -> list[pa.Array] | None:
    """The fields of a block by column; None if the reader refuses the block or sees other records in it."""
    n = len(records)
    index = pa.array(np.arange(n)).cast(pa.string())  # leads each record, and proves that the reader saw the same records
    body = "\n".join(pc.binary_join_element_wise(index, records, ",").to_pylist()).encode()
    names = [str(i) for i in range(width + 1)]
    try:
        table = pacsv.read_csv(
            pa.py_buffer(body),
            read_options=pacsv.ReadOptions(column_names=names, use_threads=False, block_size=len(body) + 1024),
            parse_options=pacsv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False),
            convert_options=pacsv.ConvertOptions(column_types={x: pa.string() for x in names}, strings_can_be_null=False),
        )
    except pa.ArrowInvalid:
        return None
    columns = [c.combine_chunks() for c in table.columns]
    return columns[1:] if table.num_rows == n and columns[0].equals(index) else None


def _whole_times(values: pa.Array) -> np.ndarray:
    """Which texts are an existing date and time in the form of TIMESTAMP; false for nulls."""
    good = pc.fill_null(pc.match_substring_regex(values, TIMESTAMP), False)
    shown = pc.if_else(good, values, pa.scalar("2000-01-01 00:00:00"))
    part = lambda a, b: pc.utf8_slice_codeunits(shown, a, b).cast(pa.int32()).to_numpy()
    year, month, day = part(0, 4), part(5, 7), part(8, 10)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    days = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.where(month <= 12, month, 0)] + (leap & (month == 2))
    return good.to_numpy(zero_copy_only=False) & (year > 0) & (day > 0) & (day <= days) & (part(11, 13) < 24) & (part(14, 16) < 60) & (part(17, 19) < 60)


def _valued(fields: list[pa.Array], columns: tuple[Column, ...]) -> tuple[list[pa.Array], np.ndarray]:
    """The values of parsed records, and which records have nothing but values that fit."""
    out, fit = [], np.ones(len(fields[0]), bool)
    for f, c in zip(fields, columns):
        v = pc.utf8_trim(f, BLANKS)
        null = pc.is_in(v, NULLS)
        v = pc.if_else(null, pa.scalar(None, pa.string()), v)
        absent = null.to_numpy(zero_copy_only=False)
        if c.required or c.values:
            fit &= ~absent
        mask = lambda x: pc.fill_null(x, False).to_numpy(zero_copy_only=False)
        if c.values:
            fit &= mask(pc.is_in(v, pa.array(c.values)))
        if c.pattern:
            fit &= absent | mask(pc.match_substring_regex(v, rf"\A(?:{c.pattern})\z"))
        if c.timestamp:
            fit &= absent | _whole_times(v)
        out.append(v)
    return out, fit


class Bisection:
    """Reads blocks of records. Those whose quotes or commas can't be right are set apart by masks; the others are parsed in bulk, those without
    quotes by splitting, those with quotes by the CSV reader. A block that it refuses is halved until the records that it refuses stand
    alone. All that don't land are read by the strict parser, which says why.

    bulk and strict count the records that landed by the columnar path and those that the strict parser saw."""

    def __init__(self, columns: tuple[Column, ...]):
        self.columns, self.bulk, self.strict = columns, 0, 0

    def read(self, records: pa.Array, land: Callable[[np.ndarray, list[pa.Array]], None], refuse: Callable[[int, str, str], None]) -> None:
        """Calls land for records that can land (their places, values by column) and refuse for each that can't (place, reason, detail)."""
        width = len(self.columns)
        plain, todo, apart = _sorted_out(records, width)
        apart, todo = [apart], [todo]

        def check(at: np.ndarray, fields: list[pa.Array]) -> None:
            values, fit = _valued(fields, self.columns)
            if not fit.all():
                apart.append(at[~fit])
                keep = pa.array(np.flatnonzero(fit))
                values, at = [v.take(keep) for v in values], at[fit]
            self.bulk += len(at)
            land(at, values)

        if len(plain):
            check(plain, _split(records.take(pa.array(plain)), width))
        while todo:
            at = todo.pop()
            if not len(at):
                continue
            fields = _parsed(records.take(pa.array(at)), width)
            if fields is not None:
                check(at, fields)
            elif len(at) > 1:
                todo += [at[len(at) // 2 :], at[: len(at) // 2]]
            else:
                apart.append(at)
        for i in np.sort(np.concatenate(apart)).tolist():
            self.strict += 1
            reason, detail, values = diagnose(records[i].as_py(), self.columns)
            if reason:
                refuse(i, reason, detail)
            else:  # the strict parser has the last word
                land(np.array([i]), [pa.array([v], pa.string()) for v in values])


def read_records(df: DataFrame, record: str, keys: list[str], columns: tuple[Column, ...]) -> DataFrame:
    """Every row of df once: its keys, the columns' values as text (null unless it can land), reason, detail and the raw record
    (both null if it can land). Reasons: QUOTING, COLUMN_COUNT, INVALID_VALUE, the first that applies. A null record has
    no fields: COLUMN_COUNT. Other columns of df are left out; a key may not be named like a column. Rows aren't moved between partitions."""
    ship(df.sparkSession)
    kept = spread(df.select(*keys, df[record].alias("raw_record")))
    names = [c.name for c in columns]
    schema = pa.schema([pa.field(n, pa.string()) for n in names] + [pa.field(n, pa.string()) for n in ("reason", "detail", "raw_record")])
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in keys] + [f"`{n}` string" for n in schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Bisection(columns)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                raw = batch.column(batch.schema.get_field_index("raw_record")).cast(pa.string())
                order: list[int] = []
                pieces: list[list[pa.Array]] = []
                bad: list[tuple[int, str, str]] = []

                def land(at: np.ndarray, values: list[pa.Array], order=order, pieces=pieces) -> None:
                    order.extend(at.tolist())
                    pieces.append(values)

                reader.read(raw, land, lambda *x, bad=bad: bad.append(x))
                m = len(bad)
                values = [pa.concat_arrays([*(p[k] for p in pieces), pa.nulls(m, pa.string())]) for k in range(len(columns))]
                order += [i for i, _, _ in bad]
                take = pa.array(order, pa.int64())
                good = len(order) - m
                values += [
                    pa.concat_arrays([pa.nulls(good, pa.string()), pa.array([r for _, r, _ in bad], pa.string())]),
                    pa.concat_arrays([pa.nulls(good, pa.string()), pa.array([d for _, _, d in bad], pa.string())]),
                    pa.concat_arrays([pa.nulls(good, pa.string()), raw.take(take.slice(good))]),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(k).take(take) for k in range(len(keys))] + values, names=[*keys, *schema.names])

    return kept.mapInArrow(run, ddl)
