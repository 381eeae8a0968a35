"""Column-expression helpers. Every function returns a ``Column`` built from
built-in Spark functions, so it stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_empty(c: ColumnOrName) -> Column:
    """'' -> NULL (SQL text extraction returns '' where a regex misses)."""
    return F.nullif(_c(c), F.lit(""))


def null_tokens(c: ColumnOrName, tokens: Sequence[str] = ("-", "")) -> Column:
    """Placeholder tokens of tab/CSV tool output -> NULL."""
    c = _c(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def field(parts: ColumnOrName, pos: int) -> Column:
    """1-based positional field of a split array; out of range -> NULL."""
    return F.get(_c(parts), pos - 1)


def int_field(c: ColumnOrName, dtype: str = "int") -> Column:
    """'' -> NULL, anything else cast strictly (bad text fails the job)."""
    c = _c(c)
    return F.when(c == "", F.lit(None).cast(dtype)).otherwise(c.cast(dtype))


def small_variant_type(ref: ColumnOrName = "ref", alt: ColumnOrName = "alt") -> Column:
    """1 x 1 base change -> SNV; everything else (MNV, multi-allelic, NULL) -> indel."""
    snv = (F.length(_c(ref)) == 1) & (F.length(_c(alt)) == 1)
    return F.when(snv, F.lit("SNV")).otherwise(F.lit("indel"))


def key_parts(key: ColumnOrName) -> dict[str, Column]:
    """chrom_start_ref_alt -> its four parts; the 4th keeps any extra '_'.
    ``start`` is cast leniently (bad text -> NULL)."""
    p = F.split(_c(key), "_", 4)
    return {
        "chrom": F.get(p, 0),
        "start": F.get(p, 1).try_cast("bigint"),
        "ref": F.get(p, 2),
        "alt": F.get(p, 3),
    }


def variant_key(chrom: ColumnOrName, start: ColumnOrName, ref: ColumnOrName,
                alt: ColumnOrName) -> Column:
    """chrom_start_ref_alt; NULL if any part is NULL (never concat_ws)."""
    sep = F.lit("_")
    return F.concat(_c(chrom), sep, _c(start).cast("string"), sep, _c(ref), sep, _c(alt))


def strip_version(c: ColumnOrName) -> Column:
    """ENSG00000123.4 -> ENSG00000123 (everything from the first dot)."""
    return F.regexp_replace(_c(c), r"\..*$", "")


def strip_chr(c: ColumnOrName) -> Column:
    """'chr21' -> '21' (every 'chr' occurrence, as a plain replace)."""
    return F.replace(_c(c), F.lit("chr"), F.lit(""))


def attr_value(attr: ColumnOrName, key: str) -> Column:
    """GTF attribute ``key "value";`` -> value, NULL when absent."""
    return nullif_empty(F.regexp_extract(_c(attr), key + r' "([^"]+)"', 1))


def has_tag(attr: ColumnOrName, tag: str) -> Column:
    """True when the attribute string carries ``tag "<tag>"``."""
    return _c(attr).contains(f'tag "{tag}"')


def paren_score(c: ColumnOrName) -> Column:
    """'deleterious(0.03)' -> 0.03; no number -> NULL."""
    # Fixed value: the pattern of a score in parentheses.
    return F.regexp_extract(_c(c), r"\(([0-9.eE+-]+)\)", 1).try_cast("double")


def row_max(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise max skipping NULLs; all NULL -> NULL."""
    cols = [_c(c) for c in cols]
    if not cols:
        raise ValueError("row_max needs at least one column")
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def text_bool(c: ColumnOrName) -> Column:
    """'True'/'true' -> true, other text -> false, NULL stays NULL."""
    return F.lower(_c(c).cast("string")) == F.lit("true")
