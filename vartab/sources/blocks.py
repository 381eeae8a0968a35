"""Block-gzipped text, read in ranges and written.

A block-gzip file (``.vcf.gz``, ``.gz``, ``.bgz``) is a series of small gzip members
that say their own size in the header, so a reader may start at any of them. The data
source ``vartab_blocks`` plans byte ranges of each file without looking into it; a
task finds the first block that starts in its range, inflates from there, and takes
every line that starts after that point up to the end of its last block: it passes by
the line it is thrown into, and follows its own last line into the next range. So each
line comes once, whatever the ranges. A file of other gzip data is read whole by the
task of its first range; the others find no block in it.
"""

from __future__ import annotations

import struct
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from vartab.sources.files import list_files, open_fs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "vartab_blocks"
SPLIT_BYTES = 32 << 20
MOST_RANGES = 4096  # of all files together, about: ranges grow beyond it
# Fixed values of the format: a member's header (with its size less one at byte 16), the
# empty member that ends a file, the most that one member holds.
_MAGIC = b"\x1f\x8b\x08\x04"
_EXTRA = b"\x06\x00BC\x02\x00"
_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_HEADER, _MOST = 18, 65_280
_READ = 1 << 20
_BATCH_BYTES = 4 << 20


def block_size(head: bytes) -> int | None:
    """Bytes of the block that starts with ``head``, None if no block starts so."""
    if len(head) < _HEADER or head[:4] != _MAGIC or head[10:16] != _EXTRA:
        return None
    return struct.unpack("<H", head[16:18])[0] + 1


def inflate(block: bytes) -> bytes | None:
    """The text of a whole block, None if the bytes are not one (its check sum says)."""
    try:
        text = zlib.decompress(block[_HEADER:-8], -15)
    except zlib.error:
        return None
    check, size = struct.unpack("<II", block[-8:])
    return text if size == len(text) and check == zlib.crc32(text) else None


def deflate(text: bytes, level: int = 6) -> bytes:
    """One block of at most ``_MOST`` bytes of text."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(text) + packer.flush()
    if len(body) + _HEADER + 8 > 1 << 16:  # does not compress
        packer = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = packer.compress(text) + packer.flush()
    size = struct.pack("<H", len(body) + _HEADER + 8 - 1)
    return _MAGIC + bytes(5) + b"\xff" + _EXTRA + size + body + struct.pack("<II", zlib.crc32(text), len(text))


class _Window:
    """Reads a file piece by piece; ``at(i, n)`` are n bytes from i on (fewer at the end)."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.held = file, size, 0, b""

    def at(self, i: int, n: int) -> bytes:
        if not self.start <= i <= i + n <= self.start + len(self.held) and i < self.size:
            self.file.seek(i)
            self.start, self.held = i, self.file.read(min(max(n, _READ), self.size - i))
        return self.held[i - self.start:i - self.start + n]


def first_block(window: _Window, start: int, end: int) -> int | None:
    """Where the first block that starts in [start, end) is. Header bytes may occur
    inside compressed data, so a block counts only if it inflates to its check sum."""
    i = start
    while i < end:
        piece = window.at(i, min(_READ, window.size - i))
        found = piece.find(_MAGIC)
        if found < 0:
            i += max(1, len(piece) - 3)
            continue
        i += found
        if i >= end:
            return None
        size = block_size(window.at(i, _HEADER))
        if size and inflate(window.at(i, size)) is not None:
            return i
        i += 1
    return None


def texts_of(window: _Window, at: int) -> Iterator[tuple[int, bytes]]:
    """(where the block starts, its text) of the blocks from ``at`` on."""
    while at < window.size:
        size = block_size(window.at(at, _HEADER))
        text = inflate(window.at(at, size)) if size else None
        if text is None:
            raise ValueError(f"damaged block at byte {at}")
        yield at, text
        at += size


def _plain_gzip(file) -> Iterator[bytes]:
    """Inflated pieces of a file of any gzip members."""
    machine = zlib.decompressobj(31)
    while piece := file.read(_READ):
        while piece:
            yield machine.decompress(piece)
            piece = machine.unused_data
            if machine.eof:
                piece, machine = piece.lstrip(b"\0"), zlib.decompressobj(31)
    yield machine.flush()


def _lines(pieces: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lists of whole lines, of about ``_BATCH_BYTES``; the last line needs no end."""
    held: list[bytes] = []
    size = 0
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= _BATCH_BYTES and b"\n" in piece:
            *lines, rest = b"".join(held).split(b"\n")
            held, size = [rest], len(rest)
            yield lines
    lines = b"".join(held).split(b"\n")
    if not lines[-1]:
        lines.pop()
    if lines:
        yield lines


def _own_text(window: _Window, first: int, end: int, at_top: bool) -> Iterator[bytes]:
    """The text of the lines that start in the blocks of a range: after its first byte
    (or with it, at the top of a file) up to the place where its last block ends."""
    blocks = texts_of(window, first)
    skipping = not at_top  # until the first line end
    for at, text in blocks:
        if skipping:
            cut = text.find(b"\n") if at < end else -1
            if at >= end:
                return  # the line goes through the whole range: its start is elsewhere
            if cut < 0:
                continue
            text, skipping = text[cut + 1:], False
        if at < end:
            yield text
            continue
        # past the range: only to the end of the line that is open, or of the next if
        # that one starts just here, as the next range passes it by
        cut = text.find(b"\n")
        if cut >= 0:
            yield text[:cut + 1]
            return
        yield text


def read_range(path: str, start: int, end: int, size: int) -> Iterator[list[bytes]]:
    """The lines of one range of a file; ranges [0, a), [a, b), ... make up the file."""
    system, inner = open_fs(path)
    with system.open_input_file(inner) as file:
        window = _Window(file, size)
        if size == 0 or block_size(window.at(0, _HEADER)) is None:
            if start == 0 and size:
                file.seek(0)
                yield from _lines(_plain_gzip(file))
            return
        first = 0 if start == 0 else first_block(window, start, end)
        if first is not None:
            yield from _lines(_own_text(window, first, end, start == 0))


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[_Range]:
        files = list_files(self.path)
        split = max(self.split, -(-sum(size for _, size in files) // MOST_RANGES))
        return [_Range(path, a, min(a + split, size), size) for path, size in files for a in range(0, max(size, 1), split)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        for lines in read_range(partition.path, partition.start, partition.end, partition.size):
            lines = [x[:-1] if x.endswith(b"\r") else x for x in lines]
            try:
                column = pa.array(lines, pa.binary()).cast(pa.string())
            except pa.ArrowInvalid:  # not UTF-8: as Spark's text reader would show it
                column = pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())
            yield pa.RecordBatch.from_arrays([column], ["value"])


@dataclass
class _Written(WriterCommitMessage):
    partition: int
    name: str


class _Writer(DataSourceWriter):
    """One file per partition, named so that names sort as partitions do. A task writes
    under a name of its own; the files of the tasks that count are renamed at the end."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.run = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex[:12]

    def write(self, iterator) -> _Written:
        from pyspark import TaskContext

        system, inner = open_fs(self.path)
        task = TaskContext.get()
        system.create_dir(inner, recursive=True)
        name = f"{inner}/_{self.run}-{task.taskAttemptId()}"
        with system.open_output_stream(name) as file:
            held = bytearray()
            for row in iterator:
                held += (row[0] or "").encode() + b"\n"
                if len(held) >= _READ:
                    whole = len(held) - len(held) % _MOST
                    file.write(b"".join(deflate(bytes(held[a:a + _MOST])) for a in range(0, whole, _MOST)))
                    del held[:whole]
            file.write(b"".join(deflate(bytes(held[a:a + _MOST])) for a in range(0, len(held), _MOST)) + _END)
        return _Written(task.partitionId(), name)

    def _clear(self, names: set[str], system, inner: str) -> None:
        """Deletes files of this run that did not count, and with ``overwrite`` the earlier data files."""
        from pyarrow import fs

        for f in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            name = f.path.rsplit("/", 1)[-1]
            stale = name.startswith(f"_{self.run}") or self.overwrite and name.startswith("part-") and name.endswith(".gz")
            if f.type == fs.FileType.File and stale and f.path not in names:
                system.delete_file(f.path)

    def commit(self, messages: list) -> None:
        system, inner = open_fs(self.path)
        system.create_dir(inner, recursive=True)
        done = [m for m in messages if m is not None]
        self._clear({m.name for m in done}, system, inner)
        for m in done:
            system.move(m.name, f"{inner}/part-{m.partition:06d}-{self.run}.gz")

    def abort(self, messages: list) -> None:
        self.overwrite = False
        system, inner = open_fs(self.path)
        self._clear(set(), system, inner)


class BlockGzip(DataSource):
    """Text lines (``value``) of block-gzip files. Options: ``path`` and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


def _registered(spark: SparkSession) -> str:
    """The name under which ``spark`` knows the format. A session that was made after
    another had registered it may refuse that name, and gets one of its own. Spark looks
    the name up in the thread's active session, which ``spark`` becomes."""
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)
    try:
        spark.dataSource.register(BlockGzip)
        return FORMAT
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    own = f"{FORMAT}_{uuid.uuid4().hex[:12]}"
    spark.dataSource.register(type("BlockGzip", (BlockGzip,), {"name": classmethod(lambda cls: own)}))
    return own


def read_blocks(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lines of the gzip files at ``path`` (a file, a folder or a glob), several tasks
    to a file where it is in blocks."""
    return spark.read.format(_registered(spark)).option("path", path).option("splitBytes", split_bytes).load()


def write_blocks(lines: DataFrame, path: str) -> None:
    """Writes lines (column ``value``) as block-gzip files, one per partition; the
    files in name order concatenate to one valid file."""
    lines.select("value").write.format(_registered(lines.sparkSession)).mode("overwrite").option("path", path).save()
