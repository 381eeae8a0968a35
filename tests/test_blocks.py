"""Block-gzip text: every cut meets every line once, and the files are plain gzip."""

import glob
import gzip
import random

import pytest
from pyspark.sql import functions as F

from vartab import sinks, sources
from vartab.sources import blocks


def bgzf(text: bytes, sizes) -> bytes:
    out, at = b"", 0
    for n in sizes:
        out += blocks.deflate(text[at:at + n])
        at += n
    return out + blocks.deflate(text[at:]) + blocks._END


def lines_of(path, start, end, size):
    return [x for part in blocks.read_range(str(path), start, end, size) for x in part]


TEXTS = [
    b"", b"one line without end", b"a\nb\nc\n", b"\n\n\nx\n\n", b"#h\n" + b"\n".join(b"line %d" % i * (i % 9 + 1) for i in range(60)) + b"\n",
    b"x" * 900 + b"\n" + b"short\n" * 3 + b"y" * 700, bytes(random.Random(1).choices(range(1, 256), k=2000)),
]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("sizes", [[], [1, 2, 3], [50] * 40, [6] * 30])
def test_every_cut_meets_every_line_once(tmp_path, text, sizes):
    path = tmp_path / "t.gz"
    data = bgzf(text, sizes)
    path.write_bytes(data)
    assert gzip.decompress(data) == text
    want = text.split(b"\n")
    if not want[-1]:
        want.pop()
    n = len(data)
    assert lines_of(path, 0, n, n) == want
    for cut in range(n + 1):
        assert lines_of(path, 0, cut, n) * (cut > 0) + lines_of(path, cut, n, n) == want, cut
    for step in (7, 64, 333):
        assert [x for a in range(0, n, step) for x in lines_of(path, a, min(a + step, n), n)] == want


def test_header_bytes_inside_the_data_are_no_block(tmp_path):
    """Stored (not deflated) blocks whose text holds headers, whole blocks even."""
    inner = blocks.deflate(b"not\na\nline\n")
    text = b"".join(b"%d " % i + inner[:18] + b"\n" for i in range(20)) + blocks._MAGIC + b"\n"
    data = bgzf(text, [64] * 8)
    path = tmp_path / "t.gz"
    path.write_bytes(data)
    n, want = len(data), text.split(b"\n")[:-1]
    for cut in range(1, n):
        assert lines_of(path, 0, cut, n) + lines_of(path, cut, n, n) == want


def test_plain_gzip_is_read_by_the_first_range(tmp_path):
    path = tmp_path / "t.gz"
    path.write_bytes(gzip.compress(b"a\nb\n") + gzip.compress(b"c\n"))
    n = path.stat().st_size
    assert lines_of(path, 0, 5, n) == [b"a", b"b", b"c"] and lines_of(path, 5, n, n) == []


def test_a_damaged_block_is_an_error(tmp_path):
    data = bytearray(bgzf(b"abc\n" * 100, [100] * 3))
    data[30] ^= 255
    path = tmp_path / "t.gz"
    path.write_bytes(bytes(data))
    with pytest.raises(ValueError, match="damaged"):
        lines_of(path, 0, len(data), len(data))


def test_blocks_that_do_not_compress():
    text = random.Random(2).randbytes(blocks._MOST)
    assert blocks.inflate(blocks.deflate(text)) == text


def test_one_file_is_read_by_several_tasks(spark, tmp_out):
    lines = spark.range(60_000, numPartitions=1).select(F.concat(F.lit("line "), F.md5(F.col("id").cast("string"))).alias("value"))
    blocks.write_blocks(lines, tmp_out)
    (file,) = glob.glob(tmp_out.removeprefix("file:") + "/*.gz")
    with gzip.open(file, "rt") as f:
        assert f.read().splitlines() == [r.value for r in lines.collect()]
    got = sources.read_blocks(spark, tmp_out, split_bytes=200_000)
    tasks = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 4 and sum(r["count"] for r in tasks) == 60_000
    assert [r.value for r in got.collect()] == [r.value for r in lines.collect()]  # ranges in order
    assert got.exceptAll(lines).count() == 0


def test_overwrite_and_globs(spark, tmp_out):
    write = lambda n: blocks.write_blocks(spark.range(n, numPartitions=3).select(F.col("id").cast("string").alias("value")), tmp_out)
    write(100)
    write(10)
    assert sources.read_blocks(spark, tmp_out).count() == 10
    assert sources.read_blocks(spark, f"{tmp_out}/part-000000*").count() < 10
    assert not glob.glob(tmp_out.removeprefix("file:") + "/_*")
    assert sources.read_blocks(spark, tmp_out).filter("value = 'é'").count() == 0


def test_vcf_in_blocks(spark, tmp_out):
    rows = [("v1", "chr1", 9, "A", "C", "CSQ=x"), ("v2", "chr2", 19, "AT", "A", ".")]
    vcf = spark.createDataFrame(rows, "variant_id string, chrom string, start long, ref string, alt string, info string")
    counts = sinks.write_vcf(vcf, ["##h", "#CHROM\tPOS"], tmp_out, compression="blocks")
    assert counts["rows"] == 2
    for kw in ({"split_bytes": 1 << 16}, {}):
        assert sorted(sources.read_vcf(spark, tmp_out, **kw).collect()) == sorted(vcf.collect())
