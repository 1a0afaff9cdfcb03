"""Attribute tables of boundary layers (``.dbf``) as a Spark data source.

A file is a header, which names fields and their widths, and records of one
width.  So a range of records can be read without the ones before it: a file is
cut into partitions, and a partition decodes only the columns asked for.  A
header that does not fit itself or the file's length fails by the file's name.
Deleted records are passed over; blank or starred numbers are missing.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from peerlens.sources.shared_files import files_of, opened, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTITION_BYTES = 64 << 20
BATCH_RECORDS = 50_000
# Fixed values of the format: sizes of the header's parts, the byte that ends the fields, types in use.
HEAD, FIELD, END_OF_FIELDS = 32, 32, 0x0D
TEXT, NUMBERS, DAY, TRUTH = "C", "NF", "D", "L"


class BrokenTable(ValueError):
    """A file that is no whole attribute table."""


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    width: int
    decimals: int
    start: int

    @property
    def type(self) -> str:
        if self.kind in NUMBERS:
            return "bigint" if self.decimals == 0 and self.kind == "N" and self.width < 19 else "double"
        return {TEXT: "string", DAY: "date", TRUTH: "boolean"}[self.kind]


@dataclass(frozen=True)
class Layout:
    records: int
    start: int
    width: int
    fields: tuple[Field, ...]


def layout_of(path: str, size: int) -> Layout:
    """The header of one file, checked."""
    with opened(path) as file:
        head = file.read(HEAD)
        if len(head) < HEAD:
            raise BrokenTable(f"{path}: no header")
        records, start, width = struct.unpack("<IHH", head[4:12])
        described = file.read(max(0, start - HEAD))
    fields, place = [], 1
    for at in range(0, len(described), FIELD):
        if described[at] == END_OF_FIELDS:
            break
        one = described[at : at + FIELD]
        if len(one) < FIELD:
            raise BrokenTable(f"{path}: field {len(fields) + 1} is cut off")
        name = one[:11].split(b"\0")[0].decode("ascii", "replace").strip()
        kind = chr(one[11])
        if kind not in TEXT + NUMBERS + DAY + TRUTH:
            raise BrokenTable(f"{path}: field {name} has the unknown type {kind!r}")
        # Long texts keep the high byte of their width where numbers keep their decimals.
        length = one[16] + (one[17] << 8 if kind == TEXT else 0)
        fields.append(Field(name, kind, length, 0 if kind == TEXT else one[17], place))
        place += length
    else:
        raise BrokenTable(f"{path}: the fields do not end")
    if place != width:
        raise BrokenTable(f"{path}: fields take {place} bytes, records {width}")
    if not fields or start + records * width > size:
        raise BrokenTable(f"{path}: {records} records of {width} bytes do not fit in {size} bytes")
    return Layout(records, start, width, tuple(fields))


def _column(cells: np.ndarray, field: Field, encoding: str, path: str) -> pa.Array:
    """One field of many records as an Arrow column."""
    flat = np.ascontiguousarray(cells).view(f"S{field.width}").ravel()
    if field.kind == TRUTH:
        return pa.array([{b"T": True, b"Y": True, b"F": False, b"N": False}.get(c.upper()) for c in flat.tolist()], pa.bool_())
    texts = pa.array([c.decode(encoding, "replace") for c in flat.tolist()], pa.string())
    if field.kind == TEXT:
        texts = pc.utf8_rtrim(texts, " \0")
        return pc.if_else(pc.equal(texts, ""), pa.scalar(None, pa.string()), texts)
    texts = pc.utf8_trim(texts, " \0")
    blank = pc.or_(pc.equal(texts, ""), pc.starts_with(texts, "*"))
    texts = pc.if_else(blank, pa.scalar(None, pa.string()), texts)
    try:
        if field.kind == DAY:
            return pc.strptime(texts, "%Y%m%d", "s").cast(pa.date32())
        return texts.cast(pa.int64() if field.type == "bigint" else pa.float64())
    except pa.ArrowInvalid as e:
        raise BrokenTable(f"{path}: field {field.name}: {e}") from e


@dataclass
class Range(InputPartition):
    path: str
    layout: Layout
    first: int
    last: int


class AttributeReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.path = schema.names, options["path"]
        self.encoding = options.get("encoding", "utf-8")
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for path, size in files_of(self.path, ".dbf"):
            layout = layout_of(path, size)
            lacking = set(self.names) - {f.name for f in layout.fields}
            if lacking:
                raise BrokenTable(f"{path}: no fields {sorted(lacking)}")
            step = max(1, self.partition_bytes // layout.width)
            out += [Range(path, layout, low, min(low + step, layout.records)) for low in range(0, layout.records, step)]
        return out

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        wanted = {f.name: f for f in part.layout.fields}
        width = part.layout.width
        with opened(part.path) as file:
            file.seek(part.layout.start + part.first * width)
            for low in range(part.first, part.last, BATCH_RECORDS):
                n = min(BATCH_RECORDS, part.last - low)
                cells = np.frombuffer(file.read(n * width), np.uint8).reshape(n, width)
                cells = cells[cells[:, 0] != ord("*")]
                columns = [
                    _column(cells[:, f.start : f.start + f.width], f, self.encoding, part.path)
                    for f in (wanted[name] for name in self.names)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=list(self.names))


class AttributeTable(DataSource):
    """``spark.read.format("dbf")`` with ``path`` (a file, or a folder of files of one layout), ``encoding``, ``columns``."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def schema(self) -> str:
        files = files_of(self.options["path"], ".dbf")
        if not files:
            raise BrokenTable(f"{self.options['path']}: no .dbf file")
        fields = {f.name: f for f in layout_of(*files[0]).fields}
        asked = [c for c in self.options.get("columns", "").split(",") if c] or list(fields)
        lacking = [c for c in asked if c not in fields]
        if lacking:
            raise BrokenTable(f"{files[0][0]}: no fields {lacking}")
        return ", ".join(f"`{c}` {fields[c].type}" for c in asked)

    def reader(self, schema: StructType) -> DataSourceReader:
        return AttributeReader(schema, dict(self.options))


def read_attributes(
    spark: SparkSession, path: str, columns: Sequence[str] = (), encoding: str = "utf-8", partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """The records of a ``.dbf`` file or folder; only ``columns`` are decoded, all if none are named."""
    spark.dataSource.register(AttributeTable)
    reader = spark.read.format("dbf").option("encoding", encoding).option("partition_bytes", partition_bytes)
    return reader.option("columns", ",".join(columns)).load(path)


def record_bytes(values: Sequence[str | None], widths: Sequence[int]) -> bytes:
    """One record; texts stand left, too long ones fail."""
    cells = [(v or "").encode() for v in values]
    if any(len(c) > w for c, w in zip(cells, widths)):
        raise ValueError(f"wider than {widths}: {values}")
    return b" " + b"".join(c.ljust(w) for c, w in zip(cells, widths))


def header_bytes(fields: Sequence[tuple[str, str, int, int]], records: int) -> bytes:
    """Header of ``(name, type, width, decimals)`` fields."""
    size = HEAD + FIELD * len(fields) + 1
    head = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, records, size, 1 + sum(f[2] for f in fields))
    for name, kind, width, decimals in fields:
        low, high = (width & 255, width >> 8) if kind == TEXT else (width, decimals)
        head += struct.pack("<11sc4xBB14x", name.encode()[:10], kind.encode(), low, high)
    return head + bytes([END_OF_FIELDS])


def write_attributes(df: DataFrame, path: str, fields: Sequence[tuple[str, str, int, int]], records_per_file: int = 1_000_000) -> None:
    """Rows as text columns in the order of ``fields``, some files of bounded size in the folder ``path``."""
    widths, names = [f[2] for f in fields], [f[0] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, n_files, done = TaskContext.get().partitionId(), [], 0, []

        def put():
            nonlocal held, n_files
            written(f"{path}/part-{part:05d}-{n_files:05d}.dbf", header_bytes(fields, len(held)) + b"".join(held) + b"\x1a")
            done.append(len(held))
            held, n_files = [], n_files + 1

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                held.append(record_bytes(row, widths))
                if len(held) == records_per_file:
                    put()
        if held or part == 0:
            put()
        yield pa.RecordBatch.from_pydict({"n": pa.array(done, pa.int64())})

    rows = df.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in names])
    rows.mapInArrow(run, "n long").agg({"n": "sum"}).collect()
